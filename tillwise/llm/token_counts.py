"""Token counts under a unigram model, by dynamic programming over a trie.

A pre-token is a word between white space with the word mark in front. Its count is the number of pieces on the best
path, the one with the largest sum of piece scores; among equal sums the one with fewer pieces. A character that starts
no piece on any path counts as one unknown piece. The distinct pre-tokens of a batch are walked in sorted order, which is
a depth-first walk of their trie: best scores are kept for every prefix on the current branch, so a shared prefix is
scored once and only new letters are computed. Terminal counts are stored and reused by later batches of the task.

Null and empty texts have no tokens.
"""

from __future__ import annotations

import math
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tillwise.llm.common import with_results

MARK = "▁"


class TrieCounter:
    """Best-path piece counts for a vocabulary of (piece, score)."""

    def __init__(self, scores: dict[str, float], entries: int = 400_000):
        # Every end of a piece is an entry too, so that a walk back from the end of a prefix knows when to stop.
        self.ends: dict[str, float | None] = {piece[i:]: None for piece in scores for i in range(1, len(piece))} | scores
        self.unknown = min(scores.values(), default=0.0) - 10.0
        self.terminal: dict[str, int] = {}
        self.entries = entries
        self.computed = 0  # prefixes scored, for tests

    def add(self, words: set[str]) -> None:
        """Score new pre-tokens; the branch of the previous word is kept as far as the next one shares it.

        `best[i]` is the best score of the first i letters and `counts[i]` the pieces on that path; the mark comes first.
        """
        ends, unknown, terminal = self.ends, self.unknown, self.terminal
        branch, best, counts = "", [0.0], [0]
        for plain in sorted(words):
            word = MARK + plain
            shared, most = 0, min(len(branch), len(word))
            while shared < most and branch[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :], counts[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top, count = best[end - 1] + unknown, counts[end - 1] + 1
                start = end - 1
                while start >= 0 and (piece := word[start:end]) in ends:
                    own = ends[piece]
                    if own is not None:
                        score = best[start] + own
                        if score > top or score == top and counts[start] < count - 1:
                            top, count = score, counts[start] + 1
                    start -= 1
                best.append(top)
                counts.append(count)
            self.computed += len(word) - shared
            branch = word
            terminal[plain] = counts[-1]

    def count(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """Tokens and pre-tokens of each text."""
        split = [text.split() if text else [] for text in texts]
        if len(self.terminal) > self.entries:
            self.terminal.clear()
        new = set().union(*split).difference(self.terminal)
        self.add(new)
        counts = [(sum(map(self.terminal.__getitem__, words)), len(words)) for words in split]
        for word in new:
            if len(word) > 64:  # rare, and would only fill the memory
                del self.terminal[word]
        return counts


def piece_scores(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece file with log probabilities that fall with the rank.

    The file's pieces are in order of their frequency; the score is that of Zipf's law, ln(1 / rank) less the log of
    the sum. Control, byte and unknown pieces take no part.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        (model.get_score(i), model.id_to_piece(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    pieces = [piece for _, piece in sorted(pieces, key=lambda x: -x[0])]
    total = math.log(sum(1 / rank for rank in range(1, len(pieces) + 1)))
    return {piece: -math.log(rank) - total for rank, piece in enumerate(pieces, 1)}


@lru_cache(maxsize=2)
def counter_at(path: str) -> TrieCounter:
    return TrieCounter(piece_scores(path))


def count_tokens(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """Add the number of tokens and of pre-tokens of every whole text."""

    def run(texts):
        counted = counter_at(path).count(texts)
        return [[x[0] for x in counted], [x[1] for x in counted]]

    return with_results(docs, text, {name: pa.int64(), "n_words": pa.int64()}, run)

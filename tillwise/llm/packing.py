"""Best-fit packing of tokenized documents into sequences, by hierarchical residual packing.

Every partition packs its own pieces best-fit, longest first, and emits the nearly full bins. The underfull bins go up a
tree as items: the bins of `FAN_IN` neighbouring partitions meet in one task and are packed best-fit again, and so on until
one group is left. After a best-fit pass no two bins of a group fit together, so what goes up is little, and what can
still be improved is found where groups meet. Each round writes a small table of (item, bin, offset); the place of a
piece follows from joining these tables from the top down.

A document is its ids and an end id; a null or empty text is the end id alone. Documents longer than a sequence are cut
into whole sequences and a rest. Rows with equal ids or texts are packed as separate documents.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.bpe import byte_letters, merger, packed_ids
from tillwise.llm.common import Memo, lists_of_int32, quoted, written

LIMIT = 2048
END_ID = 0
FAN_IN = 8
#: A bin with less room than 1 / NEARLY of the limit is emitted.
NEARLY = 128
#: A group passes on at most so many underfull bins, the emptiest; all of them are over half full but one, and the
#: others are emitted as they are.
PASSED_ON = 50_000

SEPARATORS = re.compile(r"[\x1c-\x1f]")
WORD = re.compile(r"[\S\x1c-\x1f]+")


class WordBpe:
    """Ids of a tokenizer that lower-cases, drops white space and marks the ends of words, word by word.

    Runs of letters, nearly all of a text, are merged as bytes whose last one is moved to a value that no letter has, so
    that it carries the end mark. Anything else goes to the tokenizer itself.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix = spec["model"]["end_of_word_suffix"]
        if not suffix or self.library("Ab \n c") != [*self.library("ab"), *self.library("c")]:
            raise ValueError("a tokenizer that drops white space and marks ends of words is needed")
        merges = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        made = [spec["model"]["vocab"]["".join(x)] for x in merges]
        if made != sorted(made):
            raise ValueError("ids must rise in the order of the merges")
        letters = byte_letters()
        # In lower-cased letters only a to z and 0x80 on occur: A to Z and 0x00 to 0x3F are free for last bytes.
        self.last = {b: bytes([b - 32]) for b in range(97, 123)} | {b: bytes([b - 128]) for b in range(128, 192)}
        ranks = {bytes([b]): -1 - b for b in range(256)}
        for token, i in spec["model"]["vocab"].items():
            body = token.removesuffix(suffix)
            word = bytes(letters[x] for x in body)
            if all(97 <= b < 123 or b >= 128 for b in word) and word:
                if body == token:
                    ranks[word] = i
                elif word[-1] in self.last:
                    ranks[word[:-1] + self.last[word[-1]]] = i
        free = 10**9
        for word in [x for x, i in ranks.items() if i < 0]:  # bytes that letters never use
            ranks[word] = free = free + 1
        self.merge = merger(ranks)
        self.parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self.pieces = Memo(self.encode_part)
        self.words = Memo(self.encode_word, 500_000)

    def library(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def encode_part(self, part: str) -> bytes:
        raw = part.encode()
        if part.isalpha() and raw[-1] in self.last and max(part) < "\u0250":
            return packed_ids(self.merge(raw[:-1] + self.last[raw[-1]]))
        return packed_ids(self.library(part))

    def encode_word(self, word: str) -> bytes:
        if word.isascii():
            word = word.lower()
            if word.isalpha():
                raw = word.encode()
                return packed_ids(self.merge(raw[:-1] + self.last[raw[-1]]))
        elif max(word) < "\u0250":
            word = self.tokenizer.normalizer.normalize_str(word)
            if word.isalpha():
                return self.encode_part(word)
        else:
            return packed_ids(self.library(word))  # beyond Latin the tokenizer's own tables decide what a letter is
        if "<|" in word:
            return packed_ids(self.library(word))
        if word[:-1].isalpha() and word[-1].isascii():  # a word and one mark or digit
            return self.words[word[:-1]] + self.pieces[word[-1]]
        return b"".join([self.pieces[x] for x in self.parts(word)])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        # str.split also splits at four separators that are no white space for the tokenizer
        words = WORD.findall(text) if SEPARATORS.search(text) else text.split()
        return b"".join(map(self.words.__getitem__, words))


@lru_cache(maxsize=2)
def word_bpe_at(path: str) -> WordBpe:
    return WordBpe(path)


def token_pieces(docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: `item` (unique), the key, `piece`, `start`, `length` and `ids`. Written once."""
    fed = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).cast("string").alias("text"))
    end = np.array([end_id], dtype="<i4").tobytes()
    key_type = fed.schema["key"].dataType.simpleString()

    def run(batches):
        task = TaskContext.get().partitionId() << 33
        count = 0
        for batch in batches:
            rows, pieces, starts, parts = [], [], [], []
            for row, value in enumerate(batch.column(1).to_pylist()):
                ids = word_bpe_at(path).encode(value) + end
                for piece, at in enumerate(range(0, len(ids), 4 * limit)):
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    parts.append(ids[at : at + 4 * limit])
            items = task + count + np.arange(len(rows), dtype=np.int64)
            count += len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(items),
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array([len(x) // 4 for x in parts], pa.int64()),
                    lists_of_int32(parts),
                ],
                names=["item", key, "piece", "start", "length", "ids"],
            )

    return written(fed.mapInArrow(run, f"item bigint, {quoted(key)} {key_type}, piece int, start bigint, length bigint, ids array<int>"))


def best_fit(items: np.ndarray, sizes: np.ndarray, limit: int) -> tuple[list[int], list[int], list[int]]:
    """Bin (the id of its first item), offset and the bin's fill for each item, packed longest first.

    Bins are kept by their room; a bit mask of the rooms in use gives the smallest one that is large enough.
    """
    order = np.lexsort((items, -sizes))
    by_room: dict[int, list[int]] = {}
    rooms = 0
    bins: list[int] = [0] * len(items)
    offsets: list[int] = [0] * len(items)
    fill: dict[int, int] = {}
    for i, item, size in zip(order.tolist(), items[order].tolist(), sizes[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_id = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, bin_id = limit, item
        bins[i], offsets[i] = bin_id, limit - room
        fill[bin_id] = limit - room + size
        room -= size
        if room:
            by_room.setdefault(room, []).append(bin_id)
            rooms |= 1 << room
    return bins, offsets, [fill[x] for x in bins]


ROUND = "item bigint, bin bigint, offset bigint, fill bigint, part bigint, open boolean"


def packed(items: np.ndarray, sizes: np.ndarray, part: int, limit: int) -> pa.RecordBatch:
    """The rows of a round for one group; the bins that go up are marked open."""
    bins, offsets, fills = best_fit(items, sizes, limit)
    bins, fills = np.array(bins, dtype=np.int64), np.array(fills, dtype=np.int64)
    up = fills < limit - limit // NEARLY
    heads, first = np.unique(bins[up], return_index=True)
    if len(heads) > PASSED_ON:
        emptiest = heads[np.argsort(fills[up][first], kind="stable")[:PASSED_ON]]
        up &= np.isin(bins, emptiest)
    columns = [items, bins, np.array(offsets, dtype=np.int64), fills, np.full(len(items), part, dtype=np.int64), up]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["item", "bin", "offset", "fill", "part", "open"])


def place(items: DataFrame, limit: int = LIMIT, item: str = "item", size: str = "length") -> DataFrame:
    """`item`, `sequence_id` and `offset` for every item; sizes from 0 to the limit. Ids must be unique."""

    def locally(batches):
        ids, sizes = [], []
        for batch in batches:
            ids.append(batch.column(0).to_numpy())
            sizes.append(batch.column(1).to_numpy())
        if ids:
            yield packed(np.concatenate(ids), np.concatenate(sizes), TaskContext.get().partitionId(), limit)

    def together(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py() if table.num_rows else 0
        return pa.Table.from_batches([packed(table.column("item").to_numpy(), table.column("size").to_numpy(), part, limit)])

    narrow = items.select(F.col(quoted(item)).cast("bigint"), F.col(quoted(size)).cast("bigint"))
    rounds = [written(narrow.mapInArrow(locally, ROUND))]
    while True:
        # one row per bin that goes up: the row of its first item has the bin's id
        rising = rounds[-1].filter("open AND item = bin").select(
            F.col("bin").alias("item"), F.col("fill").alias("size"), F.expr(f"part div {FAN_IN}").alias("part")
        )
        groups = rounds[-1].filter("open").agg(F.max("part")).first()[0]
        if groups is None or (groups == 0 and len(rounds) > 1):
            break
        rounds.append(written(rising.groupBy("part").applyInArrow(together, ROUND)))
    top = None
    for table in reversed(rounds):
        own = table.select("item", "bin", "offset")
        if top is not None:
            above = top.select(F.col("item").alias("bin"), F.col("sequence_id").alias("outer_id"), F.col("offset").alias("outer_offset"))
            own = own.join(above, "bin", "left").select(
                "item", F.coalesce("outer_id", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("outer_offset", F.lit(0))).alias("offset")
            )
        else:
            own = own.select("item", F.col("bin").alias("sequence_id"), "offset")
        top = own
    return top


def pack(docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The pieces with their ids, and where each lies: (`item`, `sequence_id`, `offset`)."""
    pieces = token_pieces(docs, path, limit, end_id, key, text)
    return pieces, place(pieces, limit)


def sequences(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """The packed sequences themselves: `sequence_id`, `ids` and the pieces' offsets. A group holds at most one sequence."""
    return (
        pieces.join(places, "item")
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("offsets"))
    )

"""BPE encoding and decoding by forced boundaries.

Every token a byte-level BPE can produce is in its vocabulary. Two adjacent bytes that stand next to each other inside
no vocabulary token can therefore never end up in one token: between them is a certain cut. A text is split at these
cuts (and where the tokenizer's own pattern splits it), the fragments are merged independently, and their ids are
concatenated. Equal fragments are merged once per task; the memory for them is bounded.

Null text counts as empty; an empty text has no ids and decodes to "". Repeated rows give repeated results.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import Memo, fresh_names, lists_of_int32, quoted, with_results

# White space as the tokenizer's pattern has it; Python's class also holds the four separators \x1c to \x1f.
CHUNK = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


PACK = [struct.Struct(f"<{n}i").pack for n in range(32)]


def packed_ids(ids: list[int]) -> bytes:
    """Little-endian 32-bit numbers."""
    return PACK[len(ids)](*ids) if len(ids) < len(PACK) else struct.pack(f"<{len(ids)}i", *ids)


def merger(ranks: dict[bytes, int]):
    """A function that merges the bytes of one piece, lowest rank first, into ids (the ranks)."""
    import tiktoken

    return tiktoken.Encoding("fragments", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class ForcedBoundaryBpe:
    """A byte-level BPE read from a `tokenizers` file."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"].get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE without a normalizer is needed")
        if spec["pre_tokenizer"].get("add_prefix_space") or not spec["pre_tokenizer"].get("use_regex", True):
            raise ValueError("the usual pattern without a space in front is needed")
        letters = byte_letters()
        ranks = {bytes(letters[x] for x in token): i for token, i in spec["model"]["vocab"].items()}
        merges = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        made = [spec["model"]["vocab"]["".join(x)] for x in merges]
        if made != sorted(made):
            raise ValueError("ids must rise in the order of the merges")
        self.words_of = regex.compile(public_tokenizers.PATTERN).findall
        self.merge = merger(ranks)
        # Pairs of bytes that are adjacent inside some token; between all other pairs is a cut.
        self.joined = {token[i : i + 2] for token in ranks for i in range(len(token) - 1)}
        added = spec.get("added_tokens", [])
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in added):
            raise ValueError("added tokens with options are not supported")
        self.added = {x["content"]: np.array([x["id"]], dtype="<i4").tobytes() for x in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split_added = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split if added else None
        self.bytes_of = [b""] * (1 + max([*ranks.values(), *(x["id"] for x in added)]))
        for token, i in ranks.items():
            self.bytes_of[i] = token
        for x in added:
            self.bytes_of[x["id"]] = x["content"].encode()
        self.chunks = Memo(self.encode_chunk)
        self.words = Memo(self.encode_word)

    def cut(self, word: bytes) -> list[bytes]:
        """Split at the forced boundaries."""
        joined = self.joined
        cuts = [i + 1 for i in range(len(word) - 1) if word[i : i + 2] not in joined]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)] if cuts else [word]

    def encode_word(self, word: str) -> bytes:
        return packed_ids([i for x in self.cut(word.encode()) for i in self.merge(x)])

    def encode_chunk(self, chunk: str) -> bytes:
        if chunk[0] == " " and chunk[1:-1].isalpha():  # the usual forms: a word, or a word and one mark
            if chunk[-1].isalpha():
                return self.words[chunk]
            if chunk[-1] in ".,;:!?":
                return self.words[chunk[:-1]] + self.words[chunk[-1]]
        return b"".join([self.words[x] for x in self.words_of(chunk)])

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        if self.split_added is None or not any(x in text for x in self.added):
            return b"".join(map(self.chunks.__getitem__, CHUNK.findall(text)))
        return b"".join(
            self.added[part] if i % 2 else b"".join(map(self.chunks.__getitem__, CHUNK.findall(part)))
            for i, part in enumerate(self.split_added(text))
        )

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer_at(path: str) -> ForcedBoundaryBpe:
    """One per Python worker and file."""
    return ForcedBoundaryBpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of every whole text."""

    def run(texts):
        encoder = tokenizer_at(path)
        return [lists_of_int32([encoder.encode(x) for x in texts])]

    return with_results(docs, text, {ids: pa.list_(pa.int32())}, run)


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that the ids stand for; null ids give an empty text."""
    kept = [x for x in docs.columns if x.lower() != text.lower()]
    (source,) = fresh_names(docs, "ids_in")
    fed = docs.select(*[F.col(quoted(x)) for x in kept], F.col(quoted(ids)).alias(source))
    schema = ", ".join([f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fed.schema.fields[:-1]] + [f"{quoted(text)} string"])

    def run(batches):
        decoder = tokenizer_at(path)
        for batch in batches:
            lists = batch.column(len(kept))
            values = lists.flatten().to_numpy().tolist()
            sizes = lists.value_lengths().fill_null(0).to_pylist()
            texts, at = [], 0
            for size in sizes:
                texts.append(decoder.decode(values[at : at + size]))
                at += size
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*kept, text])

    return fed.mapInArrow(run, schema)


def digests(coded: DataFrame, key: str = "doc_id", ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The key, `n_tokens`, and SHA-256 of the decimal ids joined by commas and of the text."""
    joined = F.array_join(F.col(quoted(ids)).cast("array<string>"), ",")
    return coded.select(
        F.col(quoted(key)),
        F.size(quoted(ids)).cast("bigint").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2(F.col(quoted(text)), 256).alias("decoded_sha256"),
    )

"""Near duplicates by SimHash fingerprints, found through Golay-code fuzzy hashing.

A fingerprint has 64 bits; a bit is set if it is set in over half of the hashes of the text's word shingles. The bits
are cut into three segments of at most 23 bits. The (23, 12) Golay code is perfect: every 23-bit word lies within three
bits of exactly one codeword. A segment's keys are the codewords nearest to the segment and to its 23 neighbours at one
bit (one index if it lies within two bits of a codeword, else six). Two segments that differ in at most two bits have a
word within one bit of both, and so share a key.

Fingerprints that differ in at most four bits differ in at most two bits in at least two segments, as two segments
with three or more bits would make six. So they share a pair of keys of one of the three pairs of segments. Distinct
fingerprints are dealt out by these pairs; within a bucket, fingerprints are compared, and links of a forest are emitted
(a link between two that are already linked in the bucket adds nothing). Components come from the links by alternating
star contraction.

Null and empty texts have the fingerprint zero, linked like any other. Repeated texts share a fingerprint, so their
number costs nothing. Documents without an id take part; a component without any id has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import quoted, with_results, written
from tillwise.operators.ordering import broadcast_if_small

BITS = 4
SHINGLE = 4
SEED = 42
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
#: Generator polynomial of the Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: A bucket with more fingerprints is walked from link to link instead of comparing all of them.
WALK = 48


def shingle_hashes(text: str | None, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of a whole text, repeats included; of the whole sequence if it is shorter."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()  # at ASCII white space
    if not words:
        return np.zeros(0, dtype=np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint as a signed number; zero without hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Add the fingerprint of every whole text, as a signed number."""
    return with_results(docs, text, {name: pa.int64()}, lambda texts: [[majority(shingle_hashes(x, size, seed)) for x in texts]])


@lru_cache(maxsize=1)
def decoded() -> np.ndarray:
    """The index (upper 12 bits) of the nearest codeword for each of the 2^23 words."""
    words = np.arange(1 << 12, dtype=np.int64) << 11
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ GENERATOR << bit - 11, rest)
    codewords = words | rest
    table = np.zeros(1 << 23, dtype=np.int16)
    one = [1 << i for i in range(23)]
    errors = [0, *one]
    errors += [one[i] | one[j] for i in range(23) for j in range(i)]
    errors += [one[i] | one[j] | one[k] for i in range(23) for j in range(i) for k in range(j)]
    for error in errors:
        table[codewords ^ error] = words >> 11
    return table


def segment_keys(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of segments: row numbers and indices, each index once a row."""
    table = decoded()
    near = np.stack([table[segment], *(table[segment ^ (1 << i)] for i in range(23))], axis=1)
    near.sort(axis=1)
    fresh = np.concatenate([np.ones((len(near), 1), dtype=bool), near[:, 1:] != near[:, :-1]], axis=1)
    rows, places = np.nonzero(fresh)
    return rows, near[rows, places].astype(np.int64)


def pair_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of fingerprints: all pairs of indices of two segments, with the number of the pair."""
    unsigned = prints.view(np.uint64)
    parts = [segment_keys((unsigned >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64)) for at, width in SEGMENTS]
    rows, keys = [], []
    for number, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        (rows_a, keys_a), (rows_b, keys_b) = parts[a], parts[b]
        many_b = np.bincount(rows_b, minlength=len(prints))
        first_b = np.cumsum(many_b) - many_b
        times = many_b[rows_a]
        left = np.repeat(np.arange(len(rows_a)), times)
        right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first_b[rows_a], times)
        rows.append(rows_a[left])
        keys.append(number << 24 | keys_a[left] << 12 | keys_b[right])
    return np.concatenate(rows), np.concatenate(keys)


def links_within(keys: np.ndarray, prints: np.ndarray, bits: int = BITS, walk: int = WALK) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints at `bits` or fewer differing bits in buckets of equal, adjacent keys."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    a, b = [], []
    small = np.repeat(sizes <= walk, sizes)
    at = np.flatnonzero(small)
    step = 1
    while len(at):  # the neighbour at each distance in turn, for all small buckets at once
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        near = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= bits]
        a.append(prints[near])
        b.append(prints[near + step])
        step += 1
    for start, size in zip(starts[sizes > walk].tolist(), sizes[sizes > walk].tolist(), strict=True):
        left = prints[start : start + size]
        while len(left) > 1:  # take one, and all that can be reached from it
            todo, left = [left[0]], left[1:]
            while todo and len(left):
                one = todo.pop()
                near = np.bitwise_count(left ^ one) <= bits
                if near.any():
                    found, left = left[near], left[~near]
                    a.append(np.full(len(found), one))
                    b.append(found)
                    todo.extend(found)
    empty = np.zeros(0, dtype=np.uint64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b])


def links(distinct: DataFrame, name: str = "fingerprint", bits: int = BITS) -> DataFrame:
    """Links (`a` < `b` as signed numbers) that join every two distinct fingerprints at `bits` or fewer differing bits.

    At most four bits: beyond that two segments need not share a key.
    """
    if not 0 <= bits <= 4:
        raise ValueError("keys are certain for at most four bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy()
            rows, keys = pair_keys(prints)
            for at in range(0, len(rows), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(keys[part].astype(np.int32)), pa.array(prints[rows[part]])], names=["key", "print"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int32), np.zeros(0, np.uint64)
        for (new_keys, new_prints), ended in gathered(batches, (np.int32, np.int64)):
            keys = np.concatenate([keys, new_keys])
            prints = np.concatenate([prints, new_prints.view(np.uint64)])
            # the last bucket may go on in the next part
            whole = len(keys) if ended or not len(keys) else int((keys == keys[-1]).argmax())
            if whole:
                a, b = (x.view(np.int64) for x in links_within(keys[:whole], prints[:whole], bits))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
                keys, prints = keys[whole:], prints[whole:]

    keys = spread(distinct.select(F.col(quoted(name)).alias("print"))).mapInArrow(keyed, "key int, print bigint")
    dealt = keys.repartition(F.col("key")).sortWithinPartitions("key")
    return dealt.mapInArrow(compared, "a bigint, b bigint").distinct()


def spread(df: DataFrame) -> DataFrame:
    """Narrow rows that are about to become many: a given number of partitions is not merged at run time."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.columns[0])


def gathered(batches: Iterator[pa.RecordBatch], kinds: tuple, rows: int = 100_000) -> Iterator[tuple[list[np.ndarray], bool]]:
    """The columns in parts of about so many rows, and whether it is the last part."""
    held: list[pa.RecordBatch] = []
    count = 0

    def taken() -> list[np.ndarray]:
        columns = [np.concatenate([x.column(i).to_numpy() for x in held]) if held else np.zeros(0, kind) for i, kind in enumerate(kinds)]
        held.clear()
        return columns

    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield taken(), False
            count = 0
    yield taken(), True


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """`node` and `root`, the smallest node of its component, for every node that has a link.

    Alternating star contraction: every node hands its larger neighbours to its smallest one, then its smaller ones,
    until nothing changes. Hubs are joined, never collected; every round is written.
    """
    edges = written(edges.select("a", "b").filter("a <> b"))
    state = None
    for _ in range(most_rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # now a > b: the node and a smaller neighbour
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small_least, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        edges = written(small.distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


#: Parts that the rows of one root are dealt to where the roots are too many to broadcast.
SALTS = 32


def classes(prints: DataFrame, least: Column, bits: int = BITS) -> DataFrame:
    """`fingerprint` and `first`, the least value of `least` in its component, from rows with a `fingerprint`.

    Minima are taken before and after the rows are dealt out. Only linked fingerprints are joined with the names of their components,
    by broadcast where these are few (they are counted), else in `SALTS` parts, so that a giant component does not meet in one task.
    """
    distinct = written(prints.groupBy("fingerprint").agg(F.min(least).alias("first")))
    roots = components(links(distinct.select("fingerprint"), bits=bits))
    joined = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left")
    linked = joined.select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    several = linked.groupBy("root").agg(F.min("first").alias("named"), F.count("*").alias("members")).filter("members > 1").drop("members")
    named = written(several)
    small = broadcast_if_small(named)
    if small is named:
        salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = linked.withColumn("salt", F.pmod(F.xxhash64("fingerprint"), F.lit(SALTS)).cast("int")).join(salted, ["root", "salt"], "left")
    else:
        found = linked.join(small, "root", "left")
    return found.select("fingerprint", F.coalesce("named", "first").alias("first"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row per document: the key, `fingerprint` (signed) and `component_id`, the smallest key reachable."""
    own = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    prints = written(fingerprints(own, "text", "fingerprint", size, seed))
    found = classes(prints, F.col("key"), bits).withColumnRenamed("first", "component_id")
    return prints.join(found, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row of each component, in full, with the columns of `docs`: that of the smallest key.

    Keys may be null (they come last) or repeated; of several rows with the chosen key one stays, of equal rows any.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own_key, own_text = f"c{names.index(key)}", f"c{names.index(text)}"
    whole = F.struct(F.xxhash64(*plain.columns).alias("h"), F.xxhash64(F.lit(1), *plain.columns).alias("i"))
    marked = plain.select(F.col(own_key).alias("key"), F.col(own_text).alias("text"), whole.alias("whole"))
    prints = written(fingerprints(marked, "text", "fingerprint", size, seed))
    least = F.struct(F.col("key").isNull().alias("none"), "key", "whole")
    chosen = classes(prints, least, bits).select("first.key", "first.whole").distinct()
    # Equal rows become one before they are dealt out; then texts and chosen rows meet in the same partitioning.
    single = plain.withColumns({"key_in": F.col(own_key), "h": whole["h"], "i": whole["i"]}).dropDuplicates(["h", "i", "key_in"])
    wanted = chosen.select("key", F.col("whole.h").alias("wh"), F.col("whole.i").alias("wi"))
    found = single.join(wanted, (F.col("h") == F.col("wh")) & (F.col("i") == F.col("wi")) & F.col("key_in").eqNullSafe(F.col("key")), "left_semi")
    return found.select(*plain.columns).toDF(*names)

"""Exact top-k search by inner product with vector-approximation files.

Every dimension is cut into `CELLS` equal cells between its least and largest component, and a vector is approximated by the numbers
of its cells, a byte each. Only these bytes are dealt out: candidates in blocks of bounded size, each of which meets each block of queries once.
As all cells of a dimension are equally wide, one matrix product over the cells gives each candidate's score up to a radius that
depends on the query alone: bounds from both sides. Candidates whose upper bound is below the kth best lower bound, first of a
block and then of all blocks, cannot be among the first k.

The exact vectors of the others are read in the order of their upper bounds: first those of the k highest bounds of each query, then, with
the kth exact score known, only those whose bound reaches it. No other exact vector is read.

Vectors that are null or hold null or non-finite components take no part, nor do rows without an id. Only vectors of one length are
compared. Ties go to the smaller id. Rows with equal ids are candidates of their own, but none of a query with that id; as queries each
has its own first k. Scores must be whole numbers below 2^53, as products of whole components are. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import prepare, quoted, written

K = 20
CELLS = 256
BLOCK = 8192  # candidates of a block
QUERY_BLOCK = 4096
SLICE = 64  # queries compared at a time


def whole(column: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, as double; null where a component is null or not finite."""
    usable = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("double")))


class Grid:
    """The cells of each dimension, for vectors of one length."""

    def __init__(self, low: np.ndarray, high: np.ndarray, cells: int = CELLS):
        self.low, self.cells = low, cells
        self.width = (high - low) / cells

    def numbers(self, vectors: np.ndarray) -> np.ndarray:
        safe = np.where(self.width > 0, self.width, 1.0)
        return np.clip(np.floor((vectors - self.low) / safe), 0, self.cells - 1).astype(np.uint8)

    def bounds(self, queries: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Middle of the score's range for each query and vector, and the radius for each query."""
        middle = self.low + self.width / 2
        scores = (queries * self.width) @ numbers.astype(np.float64).T + (queries @ middle)[:, None]
        reach = np.abs(queries) @ (np.abs(self.low) + self.width * self.cells)
        return scores, np.abs(queries) @ (self.width / 2) * (1 + 1e-9) + 1e-6 + 1e-12 * reach


def able(grid: Grid, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, numbers: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
    """For each query of a block that has candidates: its place, those that may be among the first k, the middles of their scores, the radius."""
    for at in range(0, len(queries), SLICE):
        middle, radius = grid.bounds(queries[at : at + SLICE], numbers)
        middle[query_ids[at : at + SLICE][:, None] == ids[None, :]] = -np.inf
        for row, scores in enumerate(middle):
            usable = int((scores > -np.inf).sum())
            if usable:
                most = min(k, usable)
                kth = np.partition(scores, -most)[-most]  # minus the radius: the kth best lower bound
                found = np.flatnonzero((scores >= kth - 2 * radius[row]) & (scores > -np.inf))
                yield at + row, found, scores[found], float(radius[row])


def rows_of(table: pa.Table, column: str, width: int) -> np.ndarray:
    held = table.column(column)
    flat = [x.flatten().to_numpy(zero_copy_only=False) for x in held.chunks]
    return np.concatenate([np.zeros(0), *flat]).reshape(table.num_rows, width)


def grids(vectors: DataFrame, cells: int) -> dict[int, Grid]:
    """The grid of each length: two numbers a dimension reach the driver."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            lengths = lists.value_lengths().to_numpy()
            for size in np.unique(lengths).tolist():
                some = lists.filter(pa.array(lengths == size)).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                place = np.arange(size)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, size)), pa.array(place), pa.array(some.min(0)), pa.array(some.max(0))], names=["d", "place", "low", "high"])

    parts = vectors.select("v").mapInArrow(ends, "d bigint, place bigint, low double, high double")
    rows = parts.groupBy("d", "place").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    found: dict[int, list] = {}
    for row in rows:
        found.setdefault(row["d"], []).append((row["place"], row["low"], row["high"]))
    return {d: Grid(*np.array(sorted(x))[:, 1:].T, cells) for d, x in found.items()}


PAIRS = "query bigint, candidate bigint, low double, high double"


def search(
    vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK, query_block: int = QUERY_BLOCK, cells: int = CELLS
) -> DataFrame:
    """`query_id`, `rank`, the candidate's `vec_id` and `score` for the k best candidates of every query row.

    `vector` holds whole numbers as doubles. The number of blocks follows the number of rows, so that a task's memory is
    bounded by the sizes of two blocks whatever the size of the table.
    """
    prepare(vectors.sparkSession)
    own = vectors.select(F.col(quoted(key)).cast("bigint").alias("id"), F.col(quoted(vector)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    usable = written(own.filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.col("id").isNotNull()).withColumn("row", F.monotonically_increasing_id()))
    rows, asking = usable.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    blocks, query_blocks = max(1, -(-rows // block)), max(1, -(-asking // query_block))
    known = grids(usable, cells)

    def approximated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            lengths = lists.value_lengths().to_numpy()
            for size in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == size))
                numbers = known[size].numbers(part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, size))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.full(part.num_rows, size, dtype=np.int32)), pa.array([x.tobytes() for x in numbers], pa.binary())],
                    names=["row", "id", "d", "cells"],
                )

    # Dealt out by a hash of the row, so that no frequent vector or id makes a block large.
    in_block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("c")
    in_query_block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(query_blocks)).cast("int").alias("q")
    small = usable.select("row", "id", "v").mapInArrow(approximated, "row bigint, id bigint, d int, cells binary")
    candidates = small.select("d", in_block, F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"), "row", "id", "cells")
    queries = usable.filter("asks").select(F.size("v").alias("d"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("c"), in_query_block, "row", "id", "v")

    def meet(key_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        size = key_[0].as_py()
        asked, there, low, high = [], [], [], []
        if left.num_rows and right.num_rows:
            numbers = np.frombuffer(b"".join(right.column("cells").to_pylist()), dtype=np.uint8).reshape(-1, size)
            own_rows, other_rows = left.column("row").to_numpy(), right.column("row").to_numpy()
            for place, found, scores, radius in able(known[size], left.column("id").to_numpy(), rows_of(left, "v", size), right.column("id").to_numpy(), numbers, k):
                asked.append(np.full(len(found), own_rows[place]))
                there.append(other_rows[found])
                low.append(scores - radius)
                high.append(scores + radius)
        whole_, real = np.zeros(0, np.int64), np.zeros(0)
        return pa.table({"query": np.concatenate([whole_, *asked]), "candidate": np.concatenate([whole_, *there]), "low": np.concatenate([real, *low]), "high": np.concatenate([real, *high])})

    met = queries.groupBy("d", "c", "q").cogroup(candidates.groupBy("d", "c", "q")).applyInArrow(meet, PAIRS)
    best_low = Window.partitionBy("query").orderBy(F.desc("low"))
    best_high = Window.partitionBy("query").orderBy(F.desc("high"), "candidate")
    kth_low = F.max(F.when(F.col("by_low") == k, F.col("low"))).over(Window.partitionBy("query"))
    bounded = met.withColumn("by_low", F.row_number().over(best_low)).withColumn("kth", kth_low)
    left = bounded.filter(F.col("kth").isNull() | (F.col("high") >= F.col("kth")))
    pairs = written(left.withColumn("place", F.row_number().over(best_high)).select("query", "candidate", "high", "place"))

    def exact(some: DataFrame) -> DataFrame:
        """Scores from the exact vectors of these pairs alone."""
        other = usable.select(F.col("row").alias("candidate"), F.col("id").alias("vec_id"), F.col("v").alias("y"))
        asking_ = usable.filter("asks").select(F.col("row").alias("query"), F.col("id").alias("query_id"), F.col("v").alias("x"))
        score = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda total, z: total + z)
        return some.join(other, "candidate").join(asking_, "query").select("query", "query_id", "vec_id", F.rint(score).cast("bigint").alias("score"))

    first = written(exact(pairs.filter(F.col("place") <= k)))
    reached = first.groupBy("query").agg(F.min("score").alias("least"))
    later = exact(pairs.filter(F.col("place") > k).join(reached, "query").filter(F.col("high") >= F.col("least")))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = first.unionByName(later).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

"""Whitening of embeddings by the singular values of their centred rows.

Rows are reduced to a triangle block by block (QR of the triangle so far with the next block), and the triangles of the
partitions are merged in a tree, so nothing larger than dimensions x dimensions moves. The last triangle R is solved as
one small matrix: Householder reflections make it bidiagonal, dqds (quotient-difference steps with shifts, on squares
that are never subtracted from each other but for the shift) finds the singular values, and each right singular vector
comes from the twisted factorisation of the shifted product at the index with the least residual. Vectors of nearly
equal values are made orthogonal. The covariance is never formed to find them.

An entry c becomes floor(64 * c) + 1,000,000. The fit list is each distinct vector once. Rows whose vector is null or
holds a null or non-finite entry take no part, nor do those with an entry beyond 2^52 after scaling, and those whose length is not
that of most rows (the larger length of two equally frequent ones). Rows without variance in a component (fewer
distinct vectors than components, or one only) get null for `whitened` and 0 for `explained` there. A deviation
that does not fit a long is null. Equal rows and equal keys stay as they are; null keys too. Empty vectors and empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import prepare, quoted, written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LARGEST = float(2**52)
#: Triangles merged by one task, and rows of a block that is reduced at once.
FAN_IN, BLOCK = 16, 4096
EPS = float(np.finfo(float).eps)
TINY = 1e-290


# ---------------------------------------------------------------- the small matrix


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U^T A V for a square matrix, and V, by Householder reflections from both sides."""
    a = np.array(matrix, dtype=float)
    n = len(a)
    right = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        v, length = x.copy(), float(np.linalg.norm(x))
        if length == 0:
            return v, 0.0
        v[0] += math.copysign(length, v[0])
        return v, 2 / float(v @ v)

    for k in range(n):
        v, scale = reflector(a[k:, k])
        a[k:, k:] -= scale * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v, scale = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= scale * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= scale * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def quotient_differences(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One differential step with a shift: the new q and e, and the d's; a negative d says that the shift was too large."""
    n = len(q)
    new_q, new_e, ds = np.empty(n), np.empty(n - 1), np.empty(n)
    d = q[0] - shift
    for i in range(n - 1):
        ds[i] = d
        new_q[i] = d + e[i]
        ratio = q[i + 1] / new_q[i] if abs(new_q[i]) > TINY else q[i + 1] / TINY
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
    ds[-1] = new_q[-1] = d
    return new_q, new_e, ds


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix in falling order, by dqds with deflation and splitting."""
    scale = max(float(np.max(np.abs(diagonal), initial=0)), float(np.max(np.abs(above), initial=0)))
    if scale == 0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    steps, most = 0, 60 * len(diagonal) + 200
    todo = [((diagonal / scale) ** 2, (above / scale) ** 2, 0.0)]
    while todo:
        q, e, shifted = todo.pop()
        shift, fresh = 0.0, True
        while len(q):
            if len(q) == 1:
                found.append(shifted + q[0])
                break
            # an e that changes no value any more splits the matrix
            small = np.flatnonzero(e <= EPS * EPS * (shifted + q[1:]) + TINY)
            if len(small):
                at = int(small[-1]) + 1
                if at == len(q) - 1:
                    found.append(shifted + q[-1])
                    q, e = q[:-1], e[:-1]
                else:
                    todo.append((q[:at], e[: at - 1], shifted))
                    q, e = q[at:], e[at:]
                continue
            steps += 1
            if steps > most:
                raise RuntimeError("the singular values did not settle")
            if fresh and q[0] < q[-1]:  # graded upwards: the small values belong at the end
                q, e = turned(q, e)
            fresh = False
            candidate = shift
            for attempt in range(6):
                candidate = 0.0 if attempt == 5 else candidate
                new_q, new_e, ds = quotient_differences(q, e, candidate)
                if candidate == 0.0 or ds.min() >= 0:
                    break
                # if only the last d fell below zero, the shift with it added is a lower bound
                candidate = max(0.0, candidate + float(ds[-1])) if ds[:-1].min() >= 0 else candidate / 4
            q, e, shifted = np.maximum(new_q, 0.0), np.maximum(new_e, 0.0), shifted + candidate
            shift = next_shift(q, e, float(ds.min()), float(ds[-1]))
    return scale * np.sqrt(np.maximum(np.sort(np.array(found))[::-1], 0.0))


def turned(q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same values, with the order of the rows reversed."""
    return q[::-1].copy(), e[::-1].copy()


def next_shift(q: np.ndarray, e: np.ndarray, least: float, last: float) -> float:
    """A shift near the least value: that of the last two rows if the least d (an upper bound) stands there, else a part of the least d."""
    if last > least:
        return max(0.0, least / 4)
    a, b, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    half = (a - b) / 2
    low = b - c / (half + math.copysign(math.hypot(half, math.sqrt(c)), half)) if c else min(a, b)
    return max(0.0, min(low, least))


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """A vector nearest to an eigenvector of B^T B for `value`, and the residual of its twist.

    L D L^T and U D U^T of the shifted product, from the top and the bottom, meet at the index with the least residual.
    """
    n = len(diagonal)
    d = np.where(np.abs(diagonal) > TINY, diagonal, TINY)
    big_d, low = d * d, np.append(above / d[:-1], 0.0)
    s, p = np.empty(n), np.empty(n)
    lower, upper = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = big_d[i] + s[i]
        pivot = pivot if abs(pivot) > TINY else TINY
        lower[i] = big_d[i] * low[i] / pivot
        s[i + 1] = lower[i] * low[i] * s[i] - value
    p[-1] = big_d[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = big_d[i] * low[i] * low[i] + p[i + 1]
        pivot = pivot if abs(pivot) > TINY else TINY
        ratio = big_d[i] / pivot
        upper[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    residuals = s + p + value
    k = int(np.argmin(np.abs(residuals)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
        if abs(z[i]) > 1e150:
            z /= abs(z[i])
    for i in range(k, n - 1):
        z[i + 1] = -upper[i] * z[i]
        if abs(z[i + 1]) > 1e150:
            z /= abs(z[i + 1])
    return z / np.linalg.norm(z), float(residuals[k])


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of B^T B for falling singular `values`, orthogonal also where values nearly agree."""
    n = len(diagonal)
    scale = max(float(values[0]), TINY)
    unit, over = diagonal / scale, above / scale
    product = np.diag(unit * unit + np.append(0.0, over * over)) + np.diag(unit[:-1] * over, 1) + np.diag(unit[:-1] * over, -1)
    random = np.random.default_rng(n)
    found = np.zeros((n, len(values)))
    for i, value in enumerate(values / scale):
        z, _ = twisted(unit, over, float(value * value))
        near = found[:, :i]
        for attempt in range(4):
            z = z - near @ (near.T @ z)
            z = z - near @ (near.T @ z)
            length = float(np.linalg.norm(z))
            if length > 0.1 and float(np.linalg.norm(product @ z - value * value * z)) <= 64 * n * EPS * length:
                break
            # a neighbour's vector came again: a step of inverse iteration from elsewhere
            start = z / length if length > 1e-8 else random.standard_normal(n)
            start = start - near @ (near.T @ start)
            moved = product - (value * value + (attempt + 1) * 4 * EPS) * np.eye(n)
            z = np.linalg.solve(moved, start)
            z /= np.linalg.norm(z)
        found[:, i] = z / np.linalg.norm(z)
    return found


def solve(triangle: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right singular vectors (columns) of a square matrix, the largest first; zeros beyond its rank."""
    diagonal, above, right = bidiagonal(triangle)
    values = singular_values(diagonal, above)
    many = min(components, len(values))
    values = np.where(values > 8 * len(values) * EPS * max(float(values[0]) if len(values) else 0.0, TINY), values, 0.0)
    rank = min(many, int((values > 0).sum()))
    vectors = np.zeros((len(values), many))
    if rank:
        vectors[:, :rank] = right @ right_vectors(diagonal, above, values[:rank])
    return values[:many], vectors


# ---------------------------------------------------------------- over the rows


def usable(vector: Column) -> Column:
    """The vector as integers, or null."""
    scaled = F.transform(vector.cast("array<double>"), lambda c: F.floor(SCALE * c) + OFFSET)
    fit = F.forall(vector.cast("array<double>"), lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) <= (LARGEST - OFFSET) / SCALE), F.lit(False)))
    return F.when(vector.isNotNull() & fit & (F.size(vector) > 0), scaled.cast("array<bigint>"))


def blocks_of(batches: Iterator[pa.RecordBatch], size: int, rows: int = BLOCK) -> Iterator[np.ndarray]:
    """Matrices of about so many rows from a column of lists of equal length."""
    held: list[np.ndarray] = []
    count = 0
    for batch in batches:
        held.append(batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(-1, size))
        count += batch.num_rows
        if count >= rows:
            yield np.concatenate(held)
            held, count = [], 0
    if count:
        yield np.concatenate(held)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n. The whole part of the mean is taken off as integers, so no digits are lost to the offset."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def triangle_of(rows: np.ndarray, size: int) -> np.ndarray:
    """R of the QR of some rows, filled up to a square."""
    r = np.linalg.qr(rows, mode="r") if len(rows) else np.zeros((0, size))
    return np.concatenate([r, np.zeros((size - len(r), size))]) if len(r) < size else r


def reduce_rows(fit: DataFrame, size: int, n: int, sums: np.ndarray) -> np.ndarray:
    """The triangle of all centred rows: one for each partition, merged in a tree until one is left."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, size))
        for block in blocks_of(batches, size):
            r = triangle_of(np.concatenate([r, centred(block, n, sums)]), size)
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], names=["r"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, size))
        for batch in batches:
            for one in batch.column(0):
                r = triangle_of(np.concatenate([r, one.values.to_numpy().reshape(size, size)]), size)
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], names=["r"])

    triangles = written(fit.select("x").mapInArrow(local, "r array<double>"))
    many = triangles.count()
    while many > 1:
        many = math.ceil(many / FAN_IN)
        triangles = written(triangles.repartition(many).mapInArrow(merged, "r array<double>"))
        many = min(many, triangles.count())
    found = triangles.first()  # dimensions x dimensions
    return np.array(found[0]).reshape(size, size)


@dataclass(frozen=True)
class Whitening:
    """The fitted directions: at most `COMPONENTS` of them, bounded by the dimensions."""

    n: int
    sums: np.ndarray  # whole numbers
    variances: np.ndarray  # of the components, falling; 0 beyond the rank
    directions: np.ndarray  # dimensions x components
    trace: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; NaN in components without variance."""
        scale = np.sqrt(np.where(self.variances > 0, self.variances, np.nan))
        return centred(x, self.n, self.sums) @ self.directions / scale


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, float] | None:
    """The whitening of the distinct rows of a column `x` of whole numbers, all of one length, and its identity error.

    None without rows. The sums are exact; only they, one triangle and a matrix of components x components reach the driver.
    """
    distinct = written(vectors.select("x").distinct())
    first = distinct.first()
    if first is None:
        return None
    size = len(first[0])
    n = distinct.count()
    entries = distinct.select(F.posexplode("x").alias("place", "entry")).groupBy("place").agg(F.sum(F.col("entry").cast("decimal(38,0)")).alias("total"))
    totals = dict(entries.collect())  # one number a dimension
    exact = [int(totals[i]) for i in range(size)]
    fits = max(abs(x) for x in exact) < 2**62
    sums = np.array(exact, dtype=np.int64 if fits else object)
    triangle = reduce_rows(distinct, size, n, sums)
    values, directions = solve(triangle, components)
    model = Whitening(n, sums, values * values / n, directions, float((triangle**2).sum()) / n)
    return model, identity_error(distinct, size, model)


def identity_error(distinct: DataFrame, size: int, model: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, over the components that vary."""
    k = int((model.variances > 0).sum())
    if not k:
        return 0.0

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for block in blocks_of(batches, size):
            w = model.apply(block)[:, :k]  # centred: x minus its mean before it is projected
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "part"])

    parts = distinct.select("x").mapInArrow(scatter, "place bigint, part double").groupBy("place").agg(F.sum("part"))
    total = np.zeros((k + 1) * k)
    for place, part in parts.collect():
        total[place] = part
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The exact sum of (n * x - S)^2 of each row, null where it does not fit a long."""
    bound = float(n) * float(np.abs(x).max(initial=0)) + max(abs(int(s)) for s in sums)
    if bound < 2**62:
        apart = n * x - sums.astype(np.int64)
        if float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 2**62:
            return (apart * apart).sum(axis=1).tolist()
    whole = (n * x.astype(object) - sums.astype(object)) ** 2
    return [int(s) if s < 2**63 else None for s in whole.sum(axis=1)]


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each usable row and component: the key, `component` (from 1), `n`, `deviation`, `whitened`, `explained`, `identity_error`."""
    spark = vectors.sparkSession
    prepare(spark)
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"{quoted(key)} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    own = vectors.select(F.col(quoted(key)).alias("key"), usable(F.col(quoted(vector))).alias("x")).filter("x IS NOT NULL")
    lengths = own.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    size = lengths[0]
    own = own.filter(F.size("x") == size)
    model, error = fit(own, components)  # there is a row
    many = len(model.variances)
    explained = model.variances / model.trace if model.trace > 0 else np.zeros(many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, size)
            w = model.apply(x).ravel()
            rows = len(x)
            place = pa.array(np.repeat(np.arange(rows), many))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(place),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * many, model.n)),
                    pa.array(deviations(x, model.n, model.sums), pa.int64()).take(place),
                    pa.array(w, mask=np.isnan(w)),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * many, error)),
                ],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return own.mapInArrow(run, schema)

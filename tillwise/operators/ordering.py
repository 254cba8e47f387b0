"""Running totals, order statistics and ranks that never sort a whole table in one task.

A running total over a global order is built in three steps: range-partition the rows by that
order, total each slice, and add to each row the totals of the slices before its own. The slice
number is written out with the rows before it is used, so it cannot differ between the passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.session import durable, stored

SLICE = "_tillwise_slice"

# A table of a few narrow columns is broadcast by hint only after its rows were counted.
BROADCAST_ROWS = 250_000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Mark a written table for broadcasting if it has few enough rows, else leave it to a shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, str],
    within: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running totals ``{new column: summed column}`` in a unique order.

    ``within`` restarts the totals for each combination of those (non-null) columns.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in within], *order)
    sliced = durable(ranged.withColumn(SLICE, F.spark_partition_id()))

    keys = [*within, SLICE]
    earlier = Window.partitionBy(*within).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = sliced.groupBy(*keys).agg(*[F.sum(c).alias(f"_{new}_slice") for new, c in totals.items()])
    before = before.select(
        *keys, *[F.coalesce(F.sum(f"_{new}_slice").over(earlier), F.lit(0)).alias(f"_{new}_before") for new in totals]
    )
    if not within:
        before = broadcast_if_small(durable(before))  # one row per shuffle partition

    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.withColumns({f"_{new}_inside": F.sum(c).over(inside) for new, c in totals.items()})
    joined = local.join(before, keys)
    return joined.withColumns({new: F.col(f"_{new}_before") + F.col(f"_{new}_inside") for new in totals}).drop(
        SLICE, *[f"_{new}_{part}" for new in totals for part in ("before", "inside")]
    )


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct non-null value; hot values shrink to one row before the shuffle."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("rows"))


def order_statistics(
    df: DataFrame,
    value: str,
    positions: Mapping[str, Column],
    by: Sequence[str] = (),
    rows: str | None = None,
) -> DataFrame:
    """Exact values at 0-based positions of the ascending order, one row per group.

    ``positions`` are expressions over ``size`` (the number of non-null values); a fractional
    position interpolates linearly between its neighbours. ``rows`` names a column of repeat counts
    when the input is already counted per value. The group sizes come back as ``size``.
    """
    counts = value_counts(df, value, by) if rows is None else df.select(*by, value, F.col(rows).alias("rows"))
    ranked = running_totals(counts, [F.col(value)], {"upto": "rows"}, within=by)
    sizes = ranked.groupBy(*by).agg(F.max("upto").alias("size"))
    placed = ranked.join(sizes, list(by)) if by else ranked.withColumn("size", sizes.scalar())

    number = F.col(value).cast("double")
    picks, finals = [F.max("size").alias("size")], []
    for name, position in positions.items():
        position = position.cast("double")
        picks += [
            F.min(F.when(F.col("upto") > F.floor(position), number)).alias(f"_{name}_low"),
            F.min(F.when(F.col("upto") > F.ceil(position), number)).alias(f"_{name}_high"),
            F.max(position - F.floor(position)).alias(f"_{name}_part"),
        ]
        low, high, part = (F.col(f"_{name}_{p}") for p in ("low", "high", "part"))
        finals.append((low + (high - low) * part).alias(name))
    return placed.groupBy(*by).agg(*picks).select(*by, "size", *finals)


def column_statistics(
    df: DataFrame, picks: Mapping[str, tuple[str, Column]], by: Sequence[str] = ()
) -> DataFrame:
    """Order statistics of several numeric columns per group from one ordering.

    ``picks`` maps a result name to a column and a position. Groups come back with ``size``, the
    largest number of values seen in a picked column.
    """
    columns = list(dict.fromkeys(column for column, _ in picks.values()))
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("number")) for c in columns]
    long = df.select(*by, F.inline(F.array(*cells)))
    positions = {name: position for name, (_, position) in picks.items()}
    found = order_statistics(long, "number", positions, by=[*by, "column"])
    return found.groupBy(*by).agg(
        F.max("size").alias("size"),
        *[F.max(F.when(F.col("column") == column, F.col(name))).alias(name) for name, (column, _) in picks.items()],
    )


def quantile_position(share: float) -> Column:
    """Position of a linearly interpolated quantile."""
    return (F.col("size") - 1) * F.lit(share)


def upper_median_position() -> Column:
    """Position of the middle value, the higher one when two are in the middle."""
    return F.floor(F.col("size") / 2)


def average_ranks(df: DataFrame, value: str, rank: str) -> DataFrame:
    """Each distinct value with the mean of the 1-based ranks its rows share, and its row count."""
    ranked = running_totals(value_counts(df, value), [F.col(value)], {"upto": "rows"})
    return ranked.select(value, "rows", (F.col("upto") - (F.col("rows") - 1) / 2).cast("double").alias(rank))


def with_row_index(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Consecutive 0-based numbers in a unique order; the rows are shuffled once."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ordered.withColumn("_tillwise_place", F.monotonically_increasing_id()))
    return number_slices(placed, [SLICE], name, F.shiftright("_tillwise_place", 33))


def number_slices(placed: DataFrame, keys: Sequence[str], name: str, slice_number: Column | None = None) -> DataFrame:
    """Turn places within slices into consecutive numbers across the slices in key order.

    ``_tillwise_place`` must rise by one from row to row of a slice. There is one offset row per slice, that
    is, per shuffle partition or file split; the offsets are counted before they are broadcast.
    """
    if slice_number is not None:
        placed = placed.withColumn(SLICE, slice_number)
    slices = placed.groupBy(*keys).agg(F.min("_tillwise_place").alias("_tillwise_first"), F.count("*").alias("_tillwise_size"))
    earlier = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_tillwise_size").over(earlier), F.lit(0)).alias("_tillwise_before")
    offsets = durable(slices.select(*keys, "_tillwise_first", before))
    numbered = placed.join(broadcast_if_small(offsets), list(keys))
    return numbered.withColumn(name, F.col("_tillwise_before") + F.col("_tillwise_place") - F.col("_tillwise_first")).drop(
        *keys, "_tillwise_place", "_tillwise_first", "_tillwise_before"
    )

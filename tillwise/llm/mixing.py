"""Mixing sources to target weights along a time-varying curriculum, by built-in functions alone.

Targets. The mix has as many words as all documents. Sources share them by weight, but none gets more than `REPEATS`
times its own size; what is above is shared again by weight until none is above. That is a water level: a source's
target is the lesser of its cap and level * weight, and the level is the largest of (words - caps of the sources filled
first) / (weights of the others), sources taken in the order of cap / weight.

Schedule. Each source has weights at equally spaced points of the training time, straight lines between them. Their
integral, scaled to the target, is the source's cumulative demand in words. Documents of a source stand in a fixed order
of digests of their keys, repeated as often as the target asks; the demand inverted at a document's first word is its
training position (0 to 1). The placements of all documents, range-sorted by position, are the mix.

The last document of a source is cut where the target (whole words, rounded down) is reached, so a source's words come
within one of its target, and no document is taken more than `REPEATS` times. Documents without words are never placed; a source without
words has the target zero. Null texts have no words; null sources are one source, the last in order; null keys come first. Rows
with equal keys follow their sizes; equal rows may change places, which no result shows. An empty table gives no rows.
Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import quoted, written
from tillwise.operators.ordering import broadcast_if_small, running_totals, with_row_index

WEIGHTS = (5, 2, 1)
REPEATS = 3
#: Weights over time, dealt to the sources in turn as `WEIGHTS` are: falling, even, rising.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def dealt(values: Sequence, place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values]), (F.pmod(place, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """`source`, `place` in the order of sources, `source_size`, `weight`, `target` from `source` and `source_size`."""
    ordered = with_row_index(sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], "place")
    placed = ordered.withColumns({"weight": dealt(weights, F.col("place")).cast("bigint"), "cap": F.col("source_size") * repeats})
    placed = placed.withColumn("filled_at", F.col("cap") / F.col("weight"))
    filled = running_totals(placed, [F.col("filled_at"), F.col("place")], {"caps": "cap", "weighed": "weight"})
    known = written(filled)
    all_words, all_weights = known.agg(F.sum("source_size")).scalar(), known.agg(F.sum("weight")).scalar()
    share = (all_words - (F.col("caps") - F.col("cap"))) / (all_weights - (F.col("weighed") - F.col("weight")))
    level = known.agg(F.max(share)).scalar()
    target = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    return known.select("source", "place", "source_size", "weight", target.alias("target"))


def demand(levels: Sequence[Sequence[float]], place: Column) -> Column:
    """The integral of a source's schedule: for each piece its start in time, its width, both weights and the share before it."""
    rows = []
    for schedule in levels:
        width = 1 / (len(schedule) - 1)
        areas = [(a + b) / 2 * width for a, b in zip(schedule, schedule[1:], strict=False)]
        if min(schedule) < 0 or not sum(areas) > 0:
            raise ValueError("weights over time must not be negative, nor all be zero")
        pieces, before = [], 0.0
        for i, area in enumerate(areas):
            share = area / sum(areas)
            values = {"start": i * width, "width": width, "first": schedule[i] / sum(areas), "last": schedule[i + 1] / sum(areas), "before": before, "share": share}
            pieces.append(F.struct(*[F.lit(float(v)).alias(k) for k, v in values.items()]))
            before += share
        rows.append(F.array(*pieces))
    return F.element_at(F.array(*rows), (F.pmod(place, F.lit(len(rows))) + 1).cast("int"))


def when_demanded(pieces: Column, share: Column) -> Column:
    """The time at which a share of a source's target has been asked for: the inverse of the integral.

    Within a piece the integral is first * t + (last - first) * t^2 / (2 * width), solved without cancellation.
    """
    piece = F.element_at(F.filter(pieces, lambda x: (x["before"] <= share) & (x["share"] > 0)), -1)
    rest = F.least(share - piece["before"], piece["share"])
    root = F.sqrt(F.greatest(piece["first"] * piece["first"] + 2 * rest * (piece["last"] - piece["first"]) / piece["width"], F.lit(0.0)))
    sum_ = piece["first"] + root
    return piece["start"] + F.least(F.when(sum_ > 0, 2 * rest / sum_).otherwise(0.0), piece["width"])


def place_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
) -> DataFrame:
    """The documents' placements in training order, written: `row`, key, `source`, `size`, `source_size`, `target`, `pass`
    (from 0), `taken` (words of this placement) and `position`. A document never taken has one row without `pass` and `position`, `taken` 0.
    """
    own = docs.select(
        F.col(quoted(key)).alias("key"),
        F.col(quoted(source)).alias("source"),
        words(F.col(quoted(text))).alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    sized = written(own)
    known = written(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats))
    joined = sized.join(broadcast_if_small(known.withColumnRenamed("source", "name")), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    order = [F.sha2(F.col("key").cast("string"), 256), F.col("key"), F.col("size"), F.col("row")]
    total = running_totals(joined, order, {"upto": "size"}, within=["place"])

    wanted = F.floor("target").cast("bigint")
    first = F.col("upto") - F.col("size")
    passes = []
    for number in range(repeats):
        begin = first + number * F.col("source_size")
        taken = F.least(F.col("size"), wanted - begin)
        share = begin / F.col("target")
        found = F.struct(F.lit(number).alias("pass"), taken.alias("taken"), when_demanded(demand(schedules, F.col("place")), share).alias("position"))
        passes.append(F.when(taken > 0, found))
    placed = total.withColumn("placed", F.explode_outer(F.array_compact(F.array(*passes))))
    named = placed.select(
        "row", F.col("key").alias(key), "source", "size", "source_size", "target", "placed.pass", F.coalesce("placed.taken", F.lit(0).cast("bigint")).alias("taken"), "placed.position"
    )
    ordered = written(named).repartitionByRange(F.col("position").asc_nulls_last(), "row", "pass")
    return written(ordered.sortWithinPartitions(F.col("position").asc_nulls_last(), "row", "pass"))


def taken_words(placements: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: key, `size`, `source_size`, `target` and all words `taken`."""
    per_row = placements.groupBy("row").agg(*[F.first(x).alias(x) for x in (key, "size", "source_size", "target")], F.sum("taken").alias("taken"))
    return per_row.drop("row")

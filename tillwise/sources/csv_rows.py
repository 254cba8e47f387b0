"""Rows of CSV files whose quoted cells may hold line breaks, read by byte ranges in many tasks.

A line break ends a row only outside quotes, and whether a byte range begins inside quotes depends on all quotes before
it. So the quotes of every range are counted first (one number a range), their running parity gives the state each
range begins in, and then every range is cut at its own rows. A row that goes on in the next ranges is put together
from the open end of its range and the heads of those that follow: a few rows a range at most.

Every quote switches between inside and outside, also in the middle of a cell; two in a row inside quotes are one
quote. A carriage return ends a row like a line feed, alone or before it. Where no line has an odd number of quotes, lines
are rows and nothing but the scan is needed. A quote that is never closed ends with its file, without a last line break.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.functions.parsing import WHITE_SPACE
from tillwise.operators.ordering import broadcast_if_small
from tillwise.session import durable, stored

FILE, BLOCK, LINE, TEXT, ODD, OPEN, RUN, KIND, PLACE, CELLS = (
    f"_tillwise_{x}" for x in ("file", "block", "line", "text", "odd", "open", "run", "kind", "place", "cells")
)
#: What a piece of text is: a whole row, the begin of one that goes on in the next range, or the end of one from before.
WHOLE, BEGUN, HEAD = "whole", "begun", "head"
#: Marks between cells and between rows while a row is taken apart; as characters of a file they are read as unknown ones.
CELL_END, ROW_END = "\x02", "\x01"
UNKNOWN = "�"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as the file has them, with their range and whether they hold an odd number of quotes."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK), F.col("value").alias(TEXT), (quotes % 2 == 1).alias(ODD)
    )


def open_ranges(lines: DataFrame) -> tuple[bool, DataFrame]:
    """Whether any line has an odd number of quotes, and the ranges that begin inside quotes."""
    counted = durable(lines.groupBy(FILE, BLOCK).agg(F.count_if(ODD).alias("odd")))
    any_odd = bool(counted.agg(F.max("odd")).first()[0])
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    state = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    return any_odd, counted.select(FILE, BLOCK, state.alias(OPEN)).where(OPEN)


def pieces(lines: DataFrame, opened: DataFrame) -> DataFrame:
    """Whole rows, begun ones and heads, in the order of the file within each range."""
    known = durable(opened)
    narrow = broadcast_if_small(known)
    joined = lines.withColumn(LINE, F.monotonically_increasing_id()).join(narrow, [FILE, BLOCK], "left")
    if narrow is known:  # too many to broadcast: the join deals the lines out anew
        joined = joined.repartition(FILE, BLOCK).sortWithinPartitions(FILE, BLOCK, LINE)
    fed = joined.select(FILE, BLOCK, F.xxhash64(FILE, BLOCK).alias(RUN), F.coalesce(OPEN, F.lit(False)).alias(OPEN), ODD, TEXT)
    return fed.mapInArrow(_cut, f"{FILE} string, {BLOCK} bigint, {KIND} string, {TEXT} string")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the lines of each range at the row ends. Only the lines of one unfinished row are held between batches."""
    held: list[str] = []  # lines of the unfinished piece
    current, kind, place = None, WHOLE, None

    def rows(names: tuple, texts: list | pa.Array, kinds: str) -> pa.RecordBatch:
        count = len(texts)
        columns = [pa.array([names[0]] * count, pa.string()), pa.array([names[1]] * count, pa.int64()), pa.array([kinds] * count, pa.string()), pa.array(texts, pa.string()) if isinstance(texts, list) else texts]
        return pa.RecordBatch.from_arrays(columns, names=[FILE, BLOCK, KIND, TEXT])

    def unfinished() -> Iterator[pa.RecordBatch]:
        if held:
            yield rows(place, ["\n".join(held)], HEAD if kind == HEAD else BEGUN)
            held.clear()

    for batch in batches:
        runs = batch.column(2).to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]])) if len(runs) else np.zeros(0, int)
        for start, end in zip(edges.tolist(), [*edges[1:].tolist(), len(runs)], strict=True):
            part = batch.slice(start, end - start)
            if runs[start] != current:
                yield from unfinished()
                current, place = runs[start], (part.column(0)[0].as_py(), part.column(1)[0].as_py())
                kind = HEAD if part.column(3)[0].as_py() else WHOLE
                inside = kind == HEAD
            odd = part.column(4).to_numpy(zero_copy_only=False)
            after = np.logical_xor(np.cumsum(odd) % 2 == 1, inside)  # inside quotes after each line
            ends = np.flatnonzero(~after) + 1
            texts = part.column(5)
            if len(ends):
                first = int(ends[0])
                yield rows(place, ["\n".join([*held, *texts.slice(0, first).to_pylist()])], kind)
                held.clear()
                kind = WHOLE
                if len(ends) > 1:
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), texts)
                    yield rows(place, pc.binary_join(lists, "\n"), WHOLE)
            held += texts.slice(int(ends[-1]) if len(ends) else 0).to_pylist()
            inside = bool(after[-1])
    yield from unfinished()


def stitched(parts: DataFrame, *carried: str) -> DataFrame:
    """The rows that begin in one range and end in a later one, from the begun pieces and the heads of a table of pieces.

    Heads follow the last range before them that has a begun row.
    """
    ends = parts.where(F.col(KIND) != WHOLE)
    order = Window.partitionBy(FILE).orderBy(BLOCK, F.col(KIND) == BEGUN)
    begun_at = F.last(F.when(F.col(KIND) == BEGUN, F.col(BLOCK)), ignorenulls=True).over(order)
    grouped = ends.withColumn("begun_at", begun_at).groupBy(FILE, F.col("begun_at").alias(BLOCK))
    texts = F.transform(F.array_sort(F.collect_list(F.struct(BLOCK, TEXT))), lambda x: x[TEXT])
    first = [F.max(F.when(F.col(KIND) == BEGUN, F.col(c))).alias(c) for c in carried]
    return grouped.agg(F.array_join(texts, "\n").alias(TEXT), *first)


def rows_of(text: Column) -> Column:
    """The rows (arrays of cells) in a text that ends outside quotes; more than one only if a lone carriage return ends a row.

    Cut at the quotes, the parts are outside and inside by turns. An empty part between two inside ones is a doubled quote.
    """
    known = _swapped(text, {CELL_END: UNKNOWN, ROW_END: UNKNOWN})
    parts = F.split(known, '"')
    last = F.size(parts) - 1

    def ended(part: Column) -> Column:
        return _swapped(part, {",": CELL_END, "\r": ROW_END})

    def marked(part: Column, at: Column) -> Column:
        literal = (part == "") & (at > 0) & (at < last)
        return F.when(at % 2 == 1, part).when(literal, F.lit('"')).otherwise(ended(part))

    joined = F.when(F.contains(known, F.lit('"')), F.array_join(F.transform(parts, marked), "")).otherwise(ended(known))
    return F.transform(F.split(joined, ROW_END), lambda row: F.split(row, CELL_END))


def _swapped(text: Column, signs: Mapping[str, str]) -> Column:
    """Some characters put for others. Replacing compares bytes, and leaves text without them as it is; translating takes all text apart."""
    for old, new in signs.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def is_blank(cells: Column) -> Column:
    others = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITE_SPACE) + "]"  # found at the first sign in most rows
    return ~F.array_join(cells, "").rlike(others)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows but blank ones as `CELLS`, written, with the range they begin in and consecutive places within it.

    Rows that end in a later range are the last of theirs, and are put in after the others are written.
    """
    lines = read_lines(spark, path)
    any_odd, opened = open_ranges(lines)
    if not any_odd:
        return stored(_parsed(lines.withColumn(KIND, F.lit(WHOLE))).withColumn(PLACE, F.monotonically_increasing_id()), compression="zstd").drop(KIND, TEXT)
    cut = pieces(lines, opened)
    parts = stored(_parsed(cut).withColumn(PLACE, F.monotonically_increasing_id()), compression="zstd")
    late = stored(_parsed(stitched(parts, PLACE).withColumn(KIND, F.lit(WHOLE))))
    columns = [FILE, BLOCK, PLACE, CELLS]
    return parts.where(F.col(KIND) == WHOLE).select(*columns).unionByName(late.select(*columns))


def _parsed(parts: DataFrame) -> DataFrame:
    """Whole rows as cells without the blank ones; other pieces as they are."""
    whole = F.col(KIND) == WHOLE
    rows = F.when(whole, F.filter(rows_of(F.col(TEXT)), lambda row: ~is_blank(row))).otherwise(F.array(F.lit(None).cast("array<string>")))
    return parts.select(*parts.columns, F.explode(rows).alias(CELLS)).withColumn(TEXT, F.when(~whole, F.col(TEXT)))

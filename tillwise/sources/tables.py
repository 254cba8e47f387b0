"""Files in: typed sales tables and uploads of unknown layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.parsing import NUMBER_SHAPE, strict_date
from tillwise.operators.ingest import ROW_INDEX
from tillwise.operators.ordering import broadcast_if_small, number_slices
from tillwise.schema import RAW_COLUMNS, RAW_SALES
from tillwise.session import durable
from tillwise.sources.csv_rows import BLOCK, CELLS, FILE, PLACE, read_rows

# Names of the library's own columns begin so.
RESERVED = "_tillwise_"

READABLE_SUFFIXES = (".csv", ".txt")
HEADER = f"{RESERVED}header"


def read_sales_csv(spark: SparkSession, path: str, typed: bool = True) -> DataFrame:
    """A raw sales table; untyped keeps the text, so that the strict gate can report bad values.

    Typed, text that is no value becomes null, and a number that does not fit its type fails: nothing is rounded.
    """
    table = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return table.select(*[_typed(f.name, f.dataType) for f in RAW_SALES.fields]) if typed else table


def _typed(name: str, kind: T.DataType) -> Column:
    text = F.col(name)
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.DateType):
        return strict_date(text, "string").alias(name)
    exact = F.regexp_extract(F.trim(text), NUMBER_SHAPE, 0).try_cast("decimal(38,18)")
    value = exact.try_cast(kind)
    message = F.concat(F.lit(f"Column '{name}' has a number that does not fit: "), text)
    return F.when(value == exact, value).when(exact.isNotNull(), F.raise_error(message).cast(kind)).alias(name)


def read_sales_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A raw sales table as stored: decimals stay exact, doubles stay doubles."""
    table = spark.read.parquet(path)
    return table.select(*[c for c in RAW_COLUMNS if c in table.columns], *[c for c in table.columns if c not in RAW_COLUMNS])


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """A month-partitioned fact table; months stay text."""
    facts = spark.read.parquet(path)
    return facts.withColumn("month", F.col("month").cast("string"))


def read_upload(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a CSV file, or of a folder of them, as text, blank rows dropped, short rows padded, rows numbered.

    Files are read by byte ranges also where quoted cells hold line breaks. The rows are written out once, and numbered by
    file and position: no order over the rows is computed. The first row of every file is its header.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    if "." in name and not name.endswith(READABLE_SUFFIXES):
        raise ValueError("Unsupported file type. Save the table as CSV.")
    rows = read_rows(spark, path)
    header = rows.where(F.col(BLOCK) == 0).select(CELLS, FILE, PLACE).orderBy(FILE, PLACE).first()
    if header is None:
        raise ValueError("The uploaded file does not contain a readable table.")
    kept = upload_names(header[CELLS])
    cells = [F.coalesce(F.get(F.col(CELLS), F.lit(i)), F.lit("")).alias(name) for i, name in kept.items()]
    heads = rows.where(F.col(BLOCK) == 0).groupBy(FILE, BLOCK).agg(F.min(PLACE).alias(HEADER))
    body = rows.join(broadcast_if_small(durable(heads)), [FILE, BLOCK], "left").where(F.col(HEADER).isNull() | (F.col(PLACE) > F.col(HEADER)))
    numbered = number_slices(body.select(FILE, BLOCK, PLACE, *cells), [FILE, BLOCK], ROW_INDEX)
    if numbered.isEmpty():
        raise ValueError("The uploaded file does not contain a readable table.")
    return numbered


def upload_names(headers: list[str | None]) -> dict[int, str]:
    """The columns to keep, by position: of headers equal after trimming the last one counts.

    Headers that differ only in case get a number, as the engine does not tell them apart.
    """
    last = {(name or "").strip(): i for i, name in enumerate(headers)}
    names: dict[int, str] = {}
    taken: set[str] = set()
    for name, i in sorted(last.items(), key=lambda x: x[1]):
        if name.lower().startswith(RESERVED):
            raise ValueError(f"Rename the column '{name}': names that begin with {RESERVED} are reserved.")
        free, number = name or f"column {i + 1}", 2
        while free.lower() in taken:
            free, number = f"{name} ({number})", number + 1
        taken.add(free.lower())
        names[i] = free
    return names

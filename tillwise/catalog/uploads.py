"""An untidy upload made from the sales lines: mixed formats, gaps, bad values and copies."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.operators.ingest import ROW_INDEX
from tillwise.operators.ordering import SLICE, number_slices
from tillwise.session import configure, ensure_checkpoint_dir, setting, stored
from tillwise.sources.star import read_table, stored_bytes

COPY = "_tillwise_copy"

# Together these identify a line.
LINE_ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_shipdate",
)
# A shuffle of the upload starts with partitions of about this size: its rows are not exploded as a cube's, and many small
# pieces of a shuffle cost more time and disk than few large ones.
UPLOAD_PARTITION_BYTES = 8 * 1024 * 1024
# Slices to be dealt over the partitions of a shuffle, so that these come out alike.
SLICES_EACH = 2
# The text of a row is parsed and written in long expressions. Java does not compile a method of more bytes than this,
# so generated code that is longer is left to separate smaller methods.
COMPILED_BYTES = "8000"


def configure_upload(spark: SparkSession, folder: str) -> None:
    """Settings for queries over the upload: it is the lines, so its shuffles are sized by them."""
    configure(spark, stored_bytes(spark, folder), UPLOAD_PARTITION_BYTES)
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_BYTES)


def untidy_date(date: str, style: str) -> F.Column:
    """Day first, month first or ISO by style; the last days of long months are unreadable."""
    return (
        F.when(F.dayofmonth(date) == 31, "not a date")
        .when(F.col(style) == "R", F.date_format(date, "d/M/yyyy"))
        .when(F.col(style) == "A", F.date_format(date, "M/d/yyyy"))
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
    )


def untidy_amount(amount: F.Column, tax: str) -> F.Column:
    """Currency text with grouped thousands; refunds stand in parentheses."""
    text = F.concat(F.lit("$"), F.format_number(amount, 2))
    return F.when(F.col(tax) == 0.08, F.concat(F.lit("("), text, F.lit(")"))).otherwise(text)


def net_amount() -> F.Column:
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    return F.round(price * (1 - F.col("l_discount").cast("decimal(4,2)")), 2).cast("decimal(15,2)")


def _costed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The stored columns of all lines with their parts."""
    lines = read_table(spark, folder, "lineitem").drop("l_linestatus")
    parts = read_table(spark, folder, "part").withColumnRenamed("p_partkey", "l_partkey")
    return lines.join(parts, "l_partkey", "left")


def _dated(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return orders.select("l_orderkey", "o_orderdate", "o_orderpriority")


def _copied() -> Column:
    """The lines returned with flag A appear a second time."""
    return F.col("l_returnflag") == "A"


def sales_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The stored columns of all lines, as often as they appear."""
    copies = F.when(_copied(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    joined = _costed_lines(spark, folder).join(_dated(spark, folder), "l_orderkey", "left").withColumn("copy", F.explode(copies))
    return joined.drop("l_partkey", "l_suppkey", "l_shipdate", "copy")


def key_slices(keys: DataFrame, key: str, slices: int) -> Callable[[DataFrame], DataFrame]:
    """A function that adds `SLICE`: rising with the key, about as many of these keys in each; below all where it is null.

    The limits come from approximate quantiles over all keys. They are numbers in the plan, so a key is in the same slice
    in every table and every pass.
    """
    shares = [i / slices for i in range(1, slices)]
    limits = sorted(set(keys.where(F.col(key).isNotNull()).approxQuantile(key, shares, 0.5 / slices))) if shares else []
    if not limits:
        return lambda df: df.withColumn(SLICE, F.when(F.col(key).isNull(), -1).otherwise(0))
    cut = Bucketizer(splits=[-math.inf, *limits, math.inf], inputCol="_tillwise_key", outputCol="_tillwise_bucket")

    def sliced(df: DataFrame) -> DataFrame:
        found = cut.transform(df.withColumn("_tillwise_key", F.coalesce(F.col(key).cast("double"), F.lit(-math.inf))))
        # Whole numbers: as a join key a double would be normalised first, and its partitioning no longer recognised.
        bucket = F.when(F.col(key).isNull(), -1).otherwise(F.col("_tillwise_bucket").cast("int"))
        return found.withColumn(SLICE, bucket).drop("_tillwise_key", "_tillwise_bucket")

    return sliced


def sales_upload(spark: SparkSession, folder: str) -> DataFrame:
    """All lines as text, numbered in their order, the second appearances after all first ones.

    The lines are dealt out once for both the join with their orders and the order over them: by slices of the order key.
    They are written as text with their places within the slices, and places become numbers with the sizes of the slices.
    """
    partitions = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = key_slices(read_table(spark, folder, "lineitem"), "l_orderkey", SLICES_EACH * partitions)
    lines = sliced(_costed_lines(spark, folder)).repartition(SLICE)
    joined = lines.join(sliced(_dated(spark, folder)), [SLICE, "l_orderkey"], "left")
    ordered = Window.partitionBy(SLICE).orderBy(*LINE_ORDER)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first, second = F.row_number().over(ordered).cast("bigint"), F.count_if(_copied()).over(so_far)
    # The sort moves the narrow stored columns; the text is made after it.
    placed = joined.withColumns({"_tillwise_first": first, "_tillwise_second": second})

    def place(copy: int, at: str) -> Column:
        return F.struct(F.lit(copy).alias(COPY), F.col(at).alias("_tillwise_place"))

    once, again = place(0, "_tillwise_first"), place(1, "_tillwise_second")
    places = F.when(_copied(), F.array(once, again)).otherwise(F.array(once))
    # The join finds the lines dealt out by a part of its key, which is enough for it.
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        texts = placed.select(SLICE, places.alias("_tillwise_places"), *untidy_columns())
        written = stored(texts.select(SLICE, F.inline("_tillwise_places"), *HEADERS), compression="zstd")
    return number_slices(written, [COPY, SLICE], ROW_INDEX).select(ROW_INDEX, *HEADERS)


def sales_file(spark: SparkSession, folder: str) -> str:
    """The upload as CSV files under the checkpoint folder; product names hold quotes, commas and line breaks."""
    named = F.coalesce(F.concat("p_type", F.lit(' "'), "p_name", F.lit('",\n('), "p_type", F.lit(")")), F.lit("")).alias("SKU Name")
    columns = [named if position == SKU else column for position, column in enumerate(untidy_columns())]
    ensure_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/upload-{uuid.uuid4().hex}"
    sales_lines(spark, folder).select(*columns).write.option("header", True).option("escape", '"').csv(place)
    return place


HEADERS = ("Invoice Date", "Invoice No", "SKU Name", "Department", "Store Type", "Qty", "Sales Value", "COGS", "Discount %")
#: Position of the product among the columns below.
SKU = 2


def untidy_columns() -> list[F.Column]:
    quantity = F.col("l_quantity").cast("bigint")
    cost = (quantity * F.col("p_retailprice").cast("decimal(15,2)")).cast("decimal(15,2)").cast("string")
    cells = [
        untidy_date("o_orderdate", "l_returnflag"),
        F.concat(F.lit("INV-"), "l_orderkey"),
        F.concat_ws(" ", "p_type", "p_name"),
        F.col("p_type"),
        F.col("o_orderpriority"),
        F.when(quantity == 50, "0").when(quantity == 49, "").otherwise(quantity.cast("string")),
        untidy_amount(net_amount(), "l_tax"),
        F.when(F.col("l_tax") == 0, "")
        .when(quantity == 1, F.concat(F.lit("("), cost, F.lit(")")))
        .otherwise(cost),
        F.when(F.col("l_linenumber") == 7, "n/a")
        .otherwise(F.concat(F.rint(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))),
    ]
    # A line without its order or part has empty cells.
    return [F.coalesce(cell, F.lit("")).alias(name) for cell, name in zip(cells, HEADERS, strict=True)]

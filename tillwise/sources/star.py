"""Sales facts out of a retail star schema (lines, orders, customers, parts)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.calendar import calendar_columns
from tillwise.functions.ratios import ratio
from tillwise.operators.filters import Filters
from tillwise.operators.keyfilter import key_filter, reduced
from tillwise.operators.totals import money_of
from tillwise.schema import DIMENSIONS, ORDER_KEY, RAW_COLUMNS, UNITS
from tillwise.session import stored

CALENDAR = frozenset({"order_date", "year", "quarter", "month", "month_of_year"})
FROM_REGION = frozenset({"region"})
FROM_CUSTOMER = frozenset({"customer_segment"}) | FROM_REGION
FROM_ORDER = frozenset({"channel"}) | CALENDAR | FROM_CUSTOMER
FROM_PART = frozenset(
    {"category", "product", "unit_cost", "cost", "gross_profit", "gross_margin", "margin_before_discount"}
)


# Fixed value: the slice of lines whose order, part or customer is missing. No join drops a line.
UNKNOWN = "Unspecified"

# Stored columns that facts replace.
STORED = (
    "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "p_retailprice",
    "c_custkey", "n_nationkey", "r_regionkey",
)

# Declared, so that opening a table reads no file footers; only the columns in use are listed.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def stored_bytes(spark: SparkSession, folder: str, name: str = "lineitem") -> int:
    """Spark's size estimate of a stored table: the bytes of its files."""
    df = read_table(spark, folder, name)
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias(ORDER_KEY), "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_type").alias("category"),
        F.concat_ws(" ", "p_type", "p_name").alias("product"),
        "p_retailprice",
    )


def _slice(df: DataFrame, within: Filters | None) -> DataFrame:
    """Keep the wanted values of the dimensions at hand; plain equality, which reaches the scan.

    Rows without a value count under `UNKNOWN`, so that value is left to a filter of the joined lines.
    """
    for dimension, value in within.active().items() if within else ():
        if dimension in df.columns and value != UNKNOWN:
            df = df.where(F.col(dimension) == value)
    return df


def _orders(spark: SparkSession, folder: str, wanted: frozenset[str], within: Filters | None) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias(ORDER_KEY),
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderpriority").alias("channel"),
    )
    if wanted & FROM_CUSTOMER:
        customer = read_table(spark, folder, "customer").select(
            "c_custkey", F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("customer_segment")
        )
        if wanted & FROM_REGION:
            nation = read_table(spark, folder, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
            region = read_table(spark, folder, "region").select("r_regionkey", F.col("r_name").alias("region"))
            customer = customer.join(nation.join(region, "r_regionkey", "left"), "n_nationkey", "left")
        orders = orders.join(customer, "c_custkey", "left")
    if within is None:
        return orders
    days = F.col("order_date").between(F.lit(within.start_date).cast("date"), F.lit(within.end_date).cast("date"))
    return _slice(orders.where(days), within)


def _fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate lets it broadcast the table in a join."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def _joined(spark: SparkSession, folder: str, wanted: frozenset[str], within: Filters | None = None) -> DataFrame:
    """Lines with the tables the wanted columns come from.

    The orders join comes last and on the narrow order key, which stays in the result: the joined
    rows are then already partitioned for counting distinct orders. Columns are derived only after
    it, so that the shuffle carries nothing but the stored ones.

    A view needs the lines of its orders only. Unless those orders are broadcast anyhow, a Bloom filter of their
    keys reduces the lines where they are scanned. Orders too many for a filter are joined first.
    """
    lines = _lines(spark, folder)
    kind, orders_first = "left", False
    if wanted & FROM_ORDER:
        orders = _orders(spark, folder, wanted, within)
        if within is not None:
            kind = "inner"
            if not _fits_broadcast(orders):
                words = key_filter(orders, ORDER_KEY)
                orders_first = words is None
                lines = lines if orders_first else reduced(lines, words, ORDER_KEY)
        if orders_first:
            lines = lines.join(orders, ORDER_KEY, kind)
    if wanted & FROM_PART:
        # A filter on a column of the parts turns the join into an inner one.
        lines = _slice(lines.join(_parts(spark, folder), "l_partkey", "left"), within)
    if wanted & FROM_ORDER and not orders_first:
        lines = lines.join(orders, ORDER_KEY, kind)
    return lines.withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in lines.columns if c in DIMENSIONS})


def order_months(spark: SparkSession, folder: str) -> DataFrame:
    """A catalogue of months from the orders alone: `month`, `lines`, `first_day`, `last_day`.

    Lines are counted by orders here: every order of the star has lines, so no month is added, and the lines are not read.
    """
    dates = read_table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))
    by_day = dates.where(F.col("order_date").isNotNull()).groupBy("order_date").agg(F.count("*").alias("lines"))
    days = (F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
    return by_day.groupBy(F.date_format("order_date", "yyyy-MM").alias("month")).agg(F.sum("lines").alias("lines"), *days)


def _whole(name: str, parts: int = 1) -> Column:
    """A stored amount in whole units of one `parts`-th. A finer amount fails: nothing is rounded."""
    value = F.col(name) * parts
    units = F.rint(value)
    fits = ~F.isnan(value) & (F.abs(value - units) <= 1e-6 + F.abs(units) * 1e-15)  # what is lost by storing decimals as doubles
    message = F.concat(F.lit(f"Column '{name}' has an amount finer than 1/{parts}: "), F.col(name).cast("string"))
    return F.when(F.col(name).isNull() | fits, units.cast("bigint")).otherwise(F.raise_error(message).cast("bigint"))


def _line_columns() -> dict[str, Column]:
    return {
        "transaction_id": F.concat(F.lit("TXN-"), F.col(ORDER_KEY) * 10 + F.col("l_linenumber")),
        "order_id": F.concat(F.lit("ORD-"), F.col(ORDER_KEY)),
        "quantity": _whole("l_quantity"),
        "discount_rate": F.col("l_discount").cast("decimal(4,2)"),
    }


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The star flattened to the raw sales columns."""
    lines = _joined(spark, folder, FROM_ORDER | FROM_PART)
    prices = {
        "list_price": (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(15,2)"),
        "unit_cost": F.col("p_retailprice").cast("decimal(15,2)"),
    }
    return lines.withColumns({**_line_columns(), **prices}).select(*RAW_COLUMNS)


def sales_facts(
    spark: SparkSession, folder: str, columns: Iterable[str] | None = None, within: Filters | None = None, pinned: bool = False
) -> DataFrame:
    """Enriched facts; joins only the tables that the named columns come from.

    ``pinned`` writes the joined lines, for facts that are read several times: their shuffles are then made once.

    ``within`` leaves out lines that these filters would drop, before the joins where that can be; it does not replace filtering.

    Leaving a join out is safe because every join keeps all lines: a line without its part, order or
    customer counts under ``Unspecified`` with no cost or date (`lineage.fact_gaps` counts such lines). With no columns named every
    table is joined. Prices must have whole cents and discounts whole percents, else the query fails; so all money is exact in ten-thousandths.
    """
    wanted = frozenset(columns) if columns is not None else FROM_ORDER | FROM_PART
    if within is not None:
        wanted |= {"order_date", *within.active()}
    facts = _joined(spark, folder, wanted, within)
    if pinned:
        facts = stored(facts, compression="zstd")

    cents = _whole("l_extendedprice", 100)
    percents = _whole("l_discount", 100)
    derived = {**_line_columns(), "gross_units": cents * 100, "discount_units": cents * percents}
    derived["net_units"] = cents * 100 - cents * percents
    money = ["gross_revenue", "discount_amount", "net_revenue"]
    if wanted & FROM_PART:
        unit_cost = _whole("p_retailprice", 100)
        derived["unit_cost"] = F.col("p_retailprice").cast("decimal(15,2)")
        derived["cost_units"] = _whole("l_quantity") * unit_cost * 100
        derived["profit_units"] = derived["net_units"] - derived["cost_units"]
        money += ["cost", "gross_profit"]
    facts = facts.withColumns(derived)
    exact = {c: money_of(F.col(UNITS[c])) for c in money}
    if wanted & FROM_PART:
        exact["gross_margin"] = ratio("profit_units", "net_units")
        exact["margin_before_discount"] = ratio(F.col("gross_units") - F.col("cost_units"), "gross_units")
    if wanted & CALENDAR:
        exact |= calendar_columns()
    return facts.withColumns(exact).drop(*STORED)

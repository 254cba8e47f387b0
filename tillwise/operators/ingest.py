"""From mapped upload rows to facts, issues and a quality report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.calendar import month_key
from tillwise.functions.parsing import as_date, as_number
from tillwise.functions.ratios import ratio_or_zero
from tillwise.functions.text import plain_number, text_or
from tillwise.operators.keyfilter import CAPACITY, key_filter, with_match
from tillwise.operators.mapping import mapping_warnings, require_mapping
from tillwise.schema import DIMENSIONS, FACT_COLUMNS
from tillwise.session import stored

ROW_INDEX = "_tillwise_row"  # 0-based position of a row in the upload; no upload may have such a header
DIGEST = "_tillwise_digest"
PACKED = "_tillwise_packed"
# Within a packed row: the end of a text, and what marks an end or a mark that the text itself has.
CELL_END, MARK = "\x1f", "\x1b"
MAX_ISSUES = 500
# One part of the digests, chosen by their values, tells beforehand how many will meet. It only chooses the way; no row is left out.
SPOT = 256

# The checks an upload goes through.
UPLOAD_CHECKS = (
    "schema_mapping",
    "date_parse",
    "numeric_sales",
    "positive_quantity",
    "cost_or_profit",
    "discount_bounds",
    "exact_duplicates",
)


@dataclass(frozen=True)
class Ingest:
    """Results of an upload; ``checked`` holds each distinct row with its parsed values."""

    rows: DataFrame
    checked: DataFrame
    mapping: Mapping[str, str]

    @property
    def facts(self) -> DataFrame:
        return assemble_facts(self.checked, self.mapping)

    @property
    def duplicates(self) -> DataFrame:
        return duplicate_rows(self.rows, self.checked)

    @property
    def issues(self) -> DataFrame:
        return row_issues(self.checked).unionByName(self.duplicates)

    @property
    def preview(self) -> DataFrame:
        """The issues a report keeps, in row order."""
        return self.issues.orderBy("row", "field").limit(MAX_ISSUES)

    @property
    def quality(self) -> DataFrame:
        return quality_report(self.rows, self.checked, self.mapping)


def _source_columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c != ROW_INDEX]


def row_digest(columns: Sequence[str]) -> Column:
    """64 bits of a row. Equal digests only send rows to the comparison, so nothing rests on their being rare."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def _meeting(digested: DataFrame) -> DataFrame:
    """Digests of several rows."""
    return digested.groupBy(DIGEST).agg(F.count("*").alias("_tillwise_met")).where(F.col("_tillwise_met") > 1)


def first_occurrences(rows: DataFrame, digest: Callable[[Sequence[str]], Column] = row_digest) -> DataFrame:
    """Distinct rows at their first position.

    Digests are shuffled first. Rows whose digest occurs once are distinct and stay where they are; a Bloom filter of the
    digests that meet tells them from the rest. Only the rest is grouped, by whole rows, which is exact whatever the digests.
    Copies collapse on the map side in both steps, so a row repeated any number of times does not burden one task. Where
    most rows are copies, all are grouped; where the digests of one part in `SPOT` show that more meet than the filter holds,
    they are so at once, without a shuffle of all digests that would tell nothing.
    """
    columns = _source_columns(rows)
    digested = rows.withColumn(DIGEST, digest(columns))
    spotted = _meeting(digested.where(F.pmod(DIGEST, F.lit(SPOT)) == 0)).count()
    words = key_filter(_meeting(digested), DIGEST) if spotted * SPOT <= CAPACITY else None
    if words is None:
        return _grouped(rows)
    told = with_match(digested, words, "_tillwise_meets", DIGEST)
    alone = told.where(~F.col("_tillwise_meets")).select(*columns, ROW_INDEX)
    return _grouped(told.where("_tillwise_meets").select(*columns, ROW_INDEX)).unionByName(alone)


def _grouped(rows: DataFrame) -> DataFrame:
    """Distinct rows at their first position, by whole rows. All text of a row is shuffled and compared as one value."""
    texts = [f.name for f in rows.schema.fields if f.dataType == T.StringType()]
    others = [c for c in _source_columns(rows) if c not in texts]
    first = F.min(ROW_INDEX).alias(ROW_INDEX)
    packed = rows.select(*[F.col(f"`{c}`") for c in others], ROW_INDEX, pack(texts).alias(PACKED))
    grouped = packed.groupBy(*[f"`{c}`" for c in others], PACKED).agg(first).withColumn(PACKED, F.split(PACKED, CELL_END))
    cells = {c: unpacked(F.get(F.col(PACKED), F.lit(i))) for i, c in enumerate(texts)}
    return grouped.select(*[cells[c].alias(c) if c in cells else F.col(f"`{c}`") for c in rows.columns])


def pack(columns: Sequence[str]) -> Column:
    """Several texts as one that no other texts make: cell ends and marks within a text are marked, and so is a null."""
    cells = [F.replace(F.replace(F.col(f"`{c}`"), F.lit(MARK), F.lit(f"{MARK}0")), F.lit(CELL_END), F.lit(f"{MARK}1")) for c in columns]
    return F.concat_ws(CELL_END, *[F.coalesce(cell, F.lit(f"{MARK}2")) for cell in cells])


def unpacked(cell: Column) -> Column:
    """A text out of a packed one that was cut at its cell ends."""
    plain = F.replace(F.replace(cell, F.lit(f"{MARK}1"), F.lit(CELL_END)), F.lit(f"{MARK}0"), F.lit(MARK))
    return F.when(cell != f"{MARK}2", plain)


def duplicate_rows(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """An issue per later copy: positions that are nobody's first. Only positions are joined."""
    later = rows.select(ROW_INDEX).join(firsts.select(ROW_INDEX), ROW_INDEX, "left_anti")
    return later.select(*_issue(F.lit("row"), F.lit(""), F.lit("Exact duplicate row")))


def _issue(field: Column, value: Column, text: Column) -> list[Column]:
    # Positions are reported as in a spreadsheet: counted from one, below a header.
    return [
        (F.col(ROW_INDEX) + 2).alias("row"),
        field.alias("field"),
        value.alias("value"),
        text.alias("issue"),
    ]


def _problem(violated: Column, field: str, value: Column, text: str) -> Column:
    return F.when(
        F.coalesce(violated, F.lit(False)),
        F.struct(F.lit(field).alias("field"), value.alias("value"), F.lit(text).alias("issue")),
    )


def _found(*problems: Column) -> Column:
    """Those of the problems that apply, as an array. Joined up from arrays of one: a function over the elements of one array
    (`array_compact`) would take the whole projection, with the parsing in it, out of generated code."""
    none = F.array().cast("array<struct<field:string,value:string,issue:string>>")
    return F.concat(*[F.when(p.isNotNull(), F.array(p)).otherwise(none) for p in problems])


def _serial(prefix: str) -> Column:
    """Position counted from one, seven digits or more."""
    number = (F.col(ROW_INDEX) + 1).cast("string")
    return F.concat(F.lit(prefix), F.lpad(number, F.greatest(F.length(number), F.lit(7)), F.lit("0")))


def check_rows(rows: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Parsed values of distinct rows with all their issues (none for a valid row)."""
    types = {f.name: f.dataType.typeName() for f in rows.schema.fields}

    def column(field: str) -> Column | None:
        return F.col(f"`{mapping[field]}`") if mapping.get(field) else None

    def shown(field: str) -> Column:
        source = column(field)
        return F.lit("") if source is None else F.coalesce(source.cast("string"), F.lit(""))

    def number(field: str, unmapped: float | None = None) -> Column:
        source = column(field)
        if source is None:
            return F.lit(unmapped).cast("double")
        return as_number(source, types[mapping[field]])

    def text(field: str, default: Column | str) -> Column:
        source = column(field)
        if source is None:
            return F.lit(default) if isinstance(default, str) else default
        return text_or(source.cast("string"), default)

    # Only the numbered row and what is parsed from it go on, so that no source column can clash with a parsed one.
    first_parsed = {
        "_date": as_date(column("order_date"), types[mapping["order_date"]]),
        "_order": text("order_id", _serial("ROW-")),
        "_product": text("product", "Unspecified product"),
        **{f"_{d}": text(d, "Unspecified") for d in DIMENSIONS if d != "product"},
        "_quantity": number("quantity", 1.0),
        "_revenue": number("net_revenue"),
        "_given_cost": number("cost"),
        "_given_profit": number("gross_profit"),
        "_given_rate": F.coalesce(number("discount_rate", 0.0), F.lit(0.0)),
        "_given_discount": number("discount_amount"),
    }
    source_values = {
        "_source_date": shown("order_date"),
        "_source_revenue": shown("net_revenue"),
        "_source_quantity": shown("quantity"),
        "_source_rate": shown("discount_rate"),
    }
    named = {**first_parsed, **source_values}
    parsed = rows.select(ROW_INDEX, *[value.alias(name) for name, value in named.items()])
    rate = F.col("_given_rate")
    parsed = parsed.withColumns(
        {
            "_cost": F.coalesce("_given_cost", F.col("_revenue") - F.col("_given_profit")),
            "_profit": F.coalesce("_given_profit", F.col("_revenue") - F.col("_given_cost")),
            "_rate": F.when((rate > 1) & (rate <= 100), rate / 100).otherwise(rate),
        }
    )
    revenue, quantity = F.col("_revenue"), F.col("_quantity")
    # The fields and texts of the issues.
    collected = _found(
        _problem(F.col("_date").isNull(), "order_date", F.col("_source_date"), "Unparseable or missing date"),
        _problem(
            revenue.isNull() | (revenue < 0),
            "net_revenue",
            F.col("_source_revenue"),
            "Revenue must be a non-negative number",
        ),
        _problem(quantity.isNull() | (quantity <= 0), "quantity", F.col("_source_quantity"), "Quantity must be positive"),
        _problem(
            F.col("_given_cost").isNull() & F.col("_given_profit").isNull(),
            "cost/profit",
            F.lit(""),
            "Cost or gross profit is required",
        ),
    )
    # Looked at only when nothing was collected, and only the first one that applies is reported.
    further = F.coalesce(
        _problem(F.col("_cost") < 0, "cost", plain_number(F.col("_cost")), "Cost cannot be negative"),
        _problem(
            (F.col("_rate") < 0) | (F.col("_rate") >= 1),
            "discount_rate",
            F.col("_source_rate"),
            "Discount rate must be between 0% and <100%",
        ),
    )
    unused = (ROW_INDEX, *source_values, "_given_cost", "_given_profit", "_given_rate")
    kept = [c for c in parsed.columns if c not in unused]
    parsed = parsed.withColumn("_collected", collected)
    several = F.col("_collected")
    issues = F.when(F.size(several) > 0, several).otherwise(_found(further))
    return parsed.select(ROW_INDEX, *kept, issues.alias("issues"))


def assemble_facts(checked: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Facts of the valid rows, with gross revenue rebuilt from the discount."""
    valid = checked.where(F.size("issues") == 0)
    rate, revenue = F.col("_rate"), F.col("_revenue")
    implied = F.when(rate == 0, 0.0).otherwise(revenue * rate / F.greatest(1 - rate, F.lit(0.0001)))
    discount = F.greatest(F.coalesce(F.col("_given_discount"), implied), F.lit(0.0))
    return (
        valid.withColumn("discount_amount", discount)
        .withColumn("gross_revenue", revenue + F.col("discount_amount"))
        .select(
            _serial("upload-").alias("transaction_id"),
            F.col("_order").alias("order_id"),
            F.col("_date").alias("order_date"),
            *[F.col(f"_{d}").alias(d) for d in DIMENSIONS],
            F.col("_quantity").alias("quantity"),
            "gross_revenue",
            "discount_amount",
            ratio_or_zero("discount_amount", "gross_revenue").alias("discount_rate"),
            revenue.alias("net_revenue"),
            F.col("_cost").alias("cost"),
            F.col("_profit").alias("gross_profit"),
            ratio_or_zero("_profit", "_revenue").alias("gross_margin"),
            month_key("_date").alias("month"),
        )
        .select(*FACT_COLUMNS)
    )


def row_issues(checked: DataFrame) -> DataFrame:
    exploded = checked.select(ROW_INDEX, F.explode("issues").alias("_found"))
    return exploded.select(*_issue(F.col("_found.field"), F.col("_found.value"), F.col("_found.issue")))


def quality_report(rows: DataFrame, checked: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Counts, score, warnings and checks of an upload in one row."""
    warnings = mapping_warnings(mapping)
    total = rows.agg(F.count("*").alias("total")).scalar()
    counted = checked.agg(
        F.count("*").alias("distinct_rows"),
        F.count_if(F.size("issues") == 0).alias("valid_rows"),
        F.coalesce(F.sum(F.size("issues")), F.lit(0)).alias("row_issues"),
    ).withColumn("total_rows", total)
    rejected = F.col("total_rows") - F.col("valid_rows")
    rejection = F.when(F.col("total_rows") == 0, 1.0).otherwise(F.try_divide(rejected, F.col("total_rows")))
    score = 100 - rejection * 100 - min(len(warnings) * 1.5, 8.0)
    repeated = F.col("total_rows") - F.col("distinct_rows")
    return counted.select(
        "total_rows",
        "valid_rows",
        rejected.alias("rejected_rows"),
        repeated.alias("duplicate_rows"),
        (F.col("row_issues") + repeated).alias("issue_count"),
        F.greatest(F.lit(0), F.floor(score + 0.5)).cast("int").alias("score"),
        F.array(*[F.lit(w) for w in warnings]).cast("array<string>").alias("warnings"),
        F.array(*[F.lit(c) for c in UPLOAD_CHECKS]).alias("checks"),
    )


def ingest(rows: DataFrame, mapping: Mapping[str, str]) -> Ingest:
    """Check upload rows numbered by ``ROW_INDEX`` under a column mapping.

    The checked rows are written out once: facts, issues and report all start from them, and a
    filter on them cannot be pushed into the parsing and repeat it.
    """
    require_mapping(mapping)
    return Ingest(rows, stored(check_rows(first_occurrences(rows), mapping), compression="zstd"), dict(mapping))

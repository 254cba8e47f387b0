"""The strict gate for raw sales tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.parsing import strict_date, strict_number
from tillwise.schema import RAW_COLUMNS
from tillwise.session import stored

# The checks of a report, in the order they are applied.
CHECKS = (
    "required_columns",
    "unexpected_columns",
    "null_values",
    "duplicate_transaction_ids",
    "id_format",
    "date_parse",
    "date_range",
    "numeric_types",
    "quantity_range",
    "price_range",
    "cost_range",
    "discount_range",
    "derived_revenue_rules",
)
# What an id looks like.
ID_SHAPES = {"transaction_id": r"^TXN-\d+$", "order_id": r"^ORD-\d+$"}

NUMERIC_COLUMNS = ("quantity", "list_price", "discount_rate", "unit_cost")
EXAMPLES = 3
DUPLICATE_EXAMPLES = 5
REPORT_SCHEMA = "check string, position int, violations bigint, message string, examples array<string>"


class DataValidationError(ValueError):
    """A table breaks the schema or a business rule."""


def _row_rules(df: DataFrame, as_of: dt.date, min_date: dt.date) -> list[tuple[str, str, Column, Column]]:
    """(check, message, violated, example) of every rule that looks at one row."""
    text = {c: F.col(c).cast("string") for c in RAW_COLUMNS}
    stored_as = {f.name: f.dataType.typeName() for f in df.schema.fields}
    number = {c: strict_number(F.col(c), stored_as[c]) for c in NUMERIC_COLUMNS}
    date = strict_date(F.col("order_date"), stored_as["order_date"])
    quantity, price, discount, unit_cost = (number[c] for c in NUMERIC_COLUMNS)
    gross = quantity * price
    # The checks' names and messages, in the order they are applied.
    rules = [
        ("null_values", "Null values found in required columns", F.col(c).isNull(), F.lit(c)) for c in RAW_COLUMNS
    ]
    rules += [("id_format", f"Malformed {c}", ~text[c].rlike(shape), text[c]) for c, shape in ID_SHAPES.items()]
    known_date = F.col("order_date").isNotNull()
    rules += [
        (
            "date_parse",
            "Invalid order_date values found; expected ISO-compatible dates.",
            known_date & date.isNull(),
            text["order_date"],
        ),
        ("date_range", "Impossible future order_date values found.", date > F.lit(as_of), text["order_date"]),
        (
            "date_range",
            f"Impossible historical order_date values found before {min_date.isoformat()}.",
            date < F.lit(min_date),
            text["order_date"],
        ),
    ]
    rules += [
        (
            "numeric_types",
            f"Column '{c}' contains invalid numeric values",
            F.col(c).isNotNull() & number[c].isNull(),
            text[c],
        )
        for c in NUMERIC_COLUMNS
    ]
    rules += [
        (
            "quantity_range",
            "Quantity must be greater than zero; zero/negative quantities are invalid.",
            quantity <= 0,
            text["quantity"],
        ),
        ("quantity_range", "Quantity must contain whole units only.", quantity % 1 != 0, text["quantity"]),
        ("price_range", "List price must be greater than zero.", price <= 0, text["list_price"]),
        ("cost_range", "Unit cost cannot be negative.", unit_cost < 0, text["unit_cost"]),
        (
            "discount_range",
            "Discount rate must be between 0 and 1 inclusive.",
            (discount < 0) | (discount > 1),
            text["discount_rate"],
        ),
        ("derived_revenue_rules", "Impossible gross revenue detected.", gross <= 0, gross.cast("string")),
        (
            "derived_revenue_rules",
            "Impossible negative net revenue detected.",
            gross * (1 - discount) < 0,
            (gross * (1 - discount)).cast("string"),
        ),
        (
            "derived_revenue_rules",
            "Impossible negative total cost detected.",
            quantity * unit_cost < 0,
            (quantity * unit_cost).cast("string"),
        ),
    ]
    return [(check, message, F.coalesce(violated, F.lit(False)), example) for check, message, violated, example in rules]


def duplicate_ids(df: DataFrame, column: str = "transaction_id") -> DataFrame:
    """Repeated ids and how often they occur."""
    return df.groupBy(column).agg(F.count("*").alias("occurrences")).where(F.col("occurrences") > 1)


def _schema_report(df: DataFrame, strict_columns: bool) -> list[tuple]:
    missing = sorted(set(RAW_COLUMNS) - set(df.columns))
    unexpected = sorted(set(df.columns) - set(RAW_COLUMNS)) if strict_columns else []
    return [
        ("required_columns", 0, len(missing), "Missing required columns", missing),
        ("unexpected_columns", 1, len(unexpected), "Unexpected columns present", unexpected),
    ]


def validation_report(
    df: DataFrame,
    as_of: dt.date | None = None,
    min_date: dt.date = dt.date(2000, 1, 1),
    strict_columns: bool = True,
) -> DataFrame:
    """Violations and examples of every rule, in the order the rules apply.

    Row rules are counted in one aggregation without a shuffle, ids in one with it. Rows are read
    again only for rules that were broken: their examples are the smallest offending values, cut
    down within each task first. Rules on rows are left out when columns are missing.
    """
    as_of = as_of or dt.date.today()
    schema_rows = _schema_report(df, strict_columns)
    if schema_rows[0][2]:
        return df.sparkSession.createDataFrame(schema_rows, REPORT_SCHEMA)

    rules = _row_rules(df, as_of, min_date)
    first = len(schema_rows)
    ids_position = first + len(RAW_COLUMNS)  # ids are checked after nulls
    positions = [first + i + (i >= len(RAW_COLUMNS)) for i in range(len(rules))]
    counts = df.agg(*[F.count_if(violated).alias(f"rule_{i}") for i, (_, _, violated, _) in enumerate(rules)]).first()
    repeats = stored(duplicate_ids(df))  # read for the total and for examples
    repeated = repeats.agg(F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).alias("n")).first().n

    nulls = len(RAW_COLUMNS)  # the rules on nulls come first, and their example is the column's name
    broken = [(position, rule) for position, rule, n in zip(positions[nulls:], rules[nulls:], counts[nulls:]) if n]
    examples = _examples(df, broken) if broken else {}
    examples |= {positions[i]: [c] * min(EXAMPLES, counts[i]) for i, c in enumerate(RAW_COLUMNS) if counts[i]}
    if repeated:
        smallest = repeats.orderBy("transaction_id").limit(DUPLICATE_EXAMPLES).collect()
        examples[ids_position] = [row.transaction_id for row in smallest]

    rows = list(schema_rows)
    rows += [
        (check, position, n, message, examples.get(position, []))
        for (check, message, _, _), position, n in zip(rules, positions, counts)
    ]
    rows.append(
        (
            "duplicate_transaction_ids",
            ids_position,
            repeated,
            "Duplicate transaction IDs found",
            examples.get(ids_position, []),
        )
    )
    return df.sparkSession.createDataFrame(sorted(rows, key=lambda row: row[1]), REPORT_SCHEMA)


def _examples(df: DataFrame, broken: list[tuple[int, tuple]]) -> dict[int, list[str]]:
    """A few of the smallest offending values per broken rule."""
    hits = [
        F.when(violated, F.struct(F.lit(position).alias("position"), example.alias("example")))
        for position, (_, _, violated, example) in broken
    ]
    smallest = Window.partitionBy("position").orderBy("example")
    found = (
        df.select(F.inline(F.array_compact(F.array(*hits))))
        .withColumn("place", F.row_number().over(smallest))
        .where(F.col("place") <= EXAMPLES)
        .orderBy("position", "place")
    )
    examples: dict[int, list[str]] = {}
    for row in found.collect():  # at most EXAMPLES per rule
        examples.setdefault(row.position, []).append(row.example)
    return examples


def check_summary(report: DataFrame) -> DataFrame:
    """Violations and outcome per check name."""
    place = F.array_position(F.array(*[F.lit(c) for c in CHECKS]), F.col("check"))
    return (
        report.groupBy("check")
        .agg(F.sum("violations").alias("violations"))
        .withColumn("status", F.when(F.col("violations") == 0, "passed").otherwise("failed"))
        .orderBy(place)
    )


def gate_status(report: DataFrame) -> str:
    """``passed`` if no rule of the report was broken, else ``failed``."""
    broken = report.agg(F.coalesce(F.sum("violations"), F.lit(0)).alias("n")).first().n
    return "failed" if broken else "passed"


def validate(
    df: DataFrame,
    as_of: dt.date | None = None,
    min_date: dt.date = dt.date(2000, 1, 1),
    strict_columns: bool = True,
) -> dict:
    """Raise for the first broken rule; otherwise describe the table."""
    rows = 0 if not df.columns else df.count()
    if rows == 0:
        raise DataValidationError("Dataset is empty; analytics cannot be produced.")
    report = validation_report(df, as_of, min_date, strict_columns)
    for row in report.collect():  # one row per rule
        if row.violations:
            detail = f": {list(row.examples)}" if not row.message.endswith(".") else ""
            raise DataValidationError(row.message + detail)
    return {"status": "passed", "row_count": rows, "column_count": len(df.columns), "checks": list(CHECKS)}


"""Numbers and dates out of free-form text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that may surround a number, and every kind of white space.
NUMBER_DECORATION = "$€£₹,%()"
WHITE_SPACE = "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
# Text the cast accepts but a spreadsheet number never has (1d, NaN, Infinity) fails this pattern.
NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Spreadsheet day numbers count from here and are believed within this open range.
SERIAL_EPOCH = "1899-12-30"
SERIAL_RANGE = (20_000, 80_000)


def parse_number(value: Column) -> Column:
    """Text such as $1,234.50 or (12%) as a double; parentheses negate; anything else is null.

    Written so that every step is evaluated once per value.
    """
    cleaned = F.translate(value, NUMBER_DECORATION + WHITE_SPACE, "")
    shaped = F.nullif(F.regexp_extract(cleaned, NUMBER_SHAPE, 0), F.lit(""))  # a cast that fails throws inside, at many times its cost
    number = shaped.try_cast("double")
    finite = F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf")))
    in_parentheses = value.contains("(") & value.contains(")")
    return finite * F.when(in_parentheses, -1.0).otherwise(1.0)


def as_number(value: Column, type_name: str) -> Column:
    """Parse text columns and pass numeric columns through."""
    if type_name == "string":
        return parse_number(value)
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def _rolled_date(year: Column, month: Column, day: Column) -> Column:
    """A date from parts, carrying a day past the end of its month into the next one."""
    first = F.make_date(year, F.lit(1), F.lit(1))
    return F.date_add(F.add_months(first, month - 1), day - 1)


def _numeric_date(text: Column, pattern: str, order: str, wide_year: Column | None = None) -> Column:
    """Read the three number groups of a pattern in the given order, for example 'mdy'."""
    part = {
        letter: F.regexp_extract(text, pattern, order.index(letter) + 1).try_cast("int")
        for letter in "ymd"
    }
    year = part["y"] if wide_year is None else wide_year
    return F.when(text.rlike(pattern), _rolled_date(year, part["m"], part["d"]))


def parse_date(value: Column) -> Column:
    """Text as a date in UTC.

    Tried in order: year first (with an optional time and zone), month first, month names,
    then day first. Days that overflow a month roll over. Anything else is null.

    Text of digits and separators can only fit the layouts without a time or a name, other text only those with one, so
    each is tried on its own layouts, in the same order.
    """
    text = F.trim(value)
    month, day = r"(0?[1-9]|1[0-2])", r"(0?[1-9]|[12]\d|3[01])"
    stamp = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
    year_first = rf"^(\d{{4}})[-/]{month}[-/]{day}$"
    month_first = rf"^{month}[-/]{day}[-/](\d{{4}})$"
    short_month_first = rf"^{month}[-/]{day}[-/](\d{{2}})$"
    day_first = r"^(\d{1,2})[-/](\d{1,2})[-/](\d{2,4})$"

    def short_year(pattern: str, turn: int) -> Column:
        number = F.regexp_extract(text, pattern, 3).try_cast("int")
        century = F.when(number < turn, 2000).when(number < 100, 1900).otherwise(0)
        return number + century

    named = F.regexp_replace(F.regexp_replace(text, r"[,.]", " "), r"[\s-]+", " ")
    year_month = F.when(text.rlike(r"^\d{4}(-(0[1-9]|1[0-2]))?$"), text)
    in_digits = F.coalesce(
        _numeric_date(text, year_first, "ymd"),
        F.try_to_date(F.concat(year_month, F.when(F.length(text) == 4, "-01-01").otherwise("-01")), "yyyy-MM-dd"),
        _numeric_date(text, month_first, "mdy"),
        _numeric_date(text, short_month_first, "mdy", short_year(short_month_first, 50)),
        _numeric_date(text, day_first, "dmy", short_year(day_first, 100)),
    )
    in_words = F.coalesce(
        F.when(text.rlike(stamp), F.to_date(F.try_to_timestamp(F.replace(text, F.lit(" "), F.lit("T"))))),
        *[
            F.when(named.rlike(shape), F.try_to_date(named, layout))
            for shape, layout in (
                (r"^[A-Za-z]{3} \d{1,2} \d{4}$", "MMM d yyyy"),
                (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
                (r"^[A-Za-z]{3,} \d{1,2} \d{4}$", "MMMM d yyyy"),
                (r"^\d{1,2} [A-Za-z]{3,} \d{4}$", "d MMMM yyyy"),
            )
        ],
    )
    # A pattern's `$` lets a line end pass.
    only_digits = ~text.rlike(r"[^0-9/\-\r\n\x{85}\x{2028}\x{2029}]")
    return F.when(only_digits, in_digits).when(text.rlike("[0-9]"), in_words)


def strict_number(value: Column, type_name: str) -> Column:
    """A finite number; text must be written as a plain one. Anything else (1d, NaN, Infinity) is null."""
    number = F.regexp_extract(F.trim(value), NUMBER_SHAPE, 0).try_cast("double") if type_name == "string" else value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def strict_date(value: Column, type_name: str) -> Column:
    """A date; text must be an ISO date that exists, with or without a time. Anything else is null."""
    if type_name in ("date", "timestamp", "timestamp_ntz"):
        return value.cast("date")
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?$"), F.substring(text, 1, 10).try_cast("date"))


def as_date(value: Column, type_name: str) -> Column:
    """Dates pass through, day numbers count from the spreadsheet epoch, text is parsed."""
    if type_name in ("date", "timestamp", "timestamp_ntz"):
        return value.cast("date")
    if type_name == "string":
        return parse_date(value)
    low, high = SERIAL_RANGE
    number = value.cast("double")
    serial = F.date_add(F.lit(SERIAL_EPOCH).cast("date"), F.floor(number).cast("int"))
    return F.when((number > low) & (number < high), serial)

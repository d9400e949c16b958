"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed formats: which texts count as a date or a number.
# (`\z`, as `$` would let a line end through)
DATE_TEXT = r"\A\d{4}-\d{1,2}-\d{1,2}\z"
NUMBER_TEXT = r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
# Whitespace that is stripped from category levels: Unicode spaces plus the four
# ASCII separators 1C-1F.
EDGE_SPACE = r"(?U)\A[\s\x1C-\x1F]+|[\s\x1C-\x1F]+\z"


def lenient_date(text: Column) -> Column:
    """Date in the first ten characters, null if there is none; month and day may be unpadded, as
    format-driven date parsers read them. Never goes through a timestamp, so no time zone can move
    the day."""
    head = F.substring(text.cast("string"), 1, 10)
    return F.when(head.rlike(DATE_TEXT), head.try_cast("date"))


def lenient_double(text: Column) -> Column:
    """Plain decimal or exponent number, else null (no suffixes, padding, line ends, nan or inf). A
    number too large for a double is null too."""
    text = text.cast("string")
    number = text.try_cast("double")
    return F.when(text.rlike(NUMBER_TEXT) & (F.abs(number) < float("inf")), number)


def month_day_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def completed_years(start: Column, end: Column) -> Column:
    """Whole years from start to end: a yyyymmdd difference loses exactly one year while
    the month and day of `start` have not come round again."""
    return F.floor((month_day_key(end) - month_day_key(start)) / 10000).cast("int")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def clean_level(value: Column) -> Column:
    """Trimmed text; null and blank become the level `Missing`."""
    text = F.regexp_replace(value.cast("string"), EDGE_SPACE, "")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("Missing")).otherwise(text)


def code_list(codes) -> tuple[str, ...]:
    """A rule's codes: one code, or several in a tuple."""
    return tuple(dict.fromkeys(map(str, codes))) if isinstance(codes, (tuple, list)) else (str(codes),)


def has_code(codes, column: str = "code") -> Column:
    """Code equality as text, with any of a rule's codes. On a text column the cast disappears and
    the filter is pushed down."""
    text, wanted = F.col(column).cast("string"), code_list(codes)
    return text == F.lit(wanted[0]) if len(wanted) == 1 else text.isin(*wanted)


def distinct_with_null(column: Column) -> Column:
    """Distinct count in which null counts as one value."""
    return F.count_distinct(column) + F.coalesce(
        F.max(F.when(column.isNull(), 1).otherwise(0)), F.lit(0)
    ).cast("bigint")


def is_true(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))


def is_false(column: Column) -> Column:
    return F.coalesce(~column, F.lit(False))


def require_columns(frame: DataFrame, needed, what: str) -> None:
    """Column contract. Compares names exactly: Spark itself resolves case-insensitively."""
    missing = sorted(set(needed) - set(frame.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")

"""Scalar column helpers for text, dates and run bookkeeping.

All of them return built-in Column expressions, so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Python's ``str.strip`` removes (Unicode
# whitespace). Spark's plain ``trim`` removes only spaces; ``TRIM(BOTH set
# FROM x)`` with this set matches Python and, unlike a regex, is cheap.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")

# The year-month text accepted as a transaction month
# (four-digit year, month 1..12 with an optional leading zero).
MONTH_PATTERN = r"^[0-9]{4}-(0?[1-9]|1[0-2])$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Trim Unicode whitespace at both ends."""
    return F.trim(_c(col), F.lit(WHITESPACE))


def normalize(col: Column | str) -> Column:
    """Upper case and trimmed (C4). NULL stays NULL."""
    return strip(F.upper(_c(col)))


def normalize_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """Normalise the listed columns that the frame has, in one projection (C4)."""
    present = {c for c in cols if c in df.columns}
    return df.select(*[normalize(c).alias(c) if c in present else F.col(c) for c in df.columns])


def month_ok(col: Column | str) -> Column:
    """Month text is ``YYYY-M`` or ``YYYY-MM`` with a month 1..12 and a year from 1."""
    c = _c(col)
    return F.coalesce(c.rlike(MONTH_PATTERN) & ~c.startswith("0000"), F.lit(False))


def month_date(col: Column | str) -> Column:
    """Parse ``YYYY-MM`` (also ``YYYY-M``) to the first day of the month; else NULL.

    The pattern guard makes the parts valid, so the date is built from them
    directly instead of running a date formatter per row.
    """
    c = _c(col)
    return F.when(month_ok(c), F.make_date(F.substring(c, 1, 4).cast("int"),
                                          F.substring_index(c, "-", -1).cast("int"), F.lit(1)))


def to_ts(col: Column | str) -> Column:
    """ISO date or timestamp text to a timestamp; unreadable gives NULL."""
    return F.try_to_timestamp(_c(col))


def sanitize_name(col: Column | str, fallback: Column | str) -> Column:
    """Letters and digits only; empty result falls back to the id."""
    cleaned = F.regexp_replace(_c(col), r"[^\p{L}\p{N}]", "")
    return F.coalesce(F.nullif(cleaned, F.lit("")), _c(fallback))


def clean_error(col: Column | str) -> Column:
    """Error text: the ``ErrorMessage`` of a JSON object, else the text itself."""
    c = _c(col)
    return F.coalesce(F.get_json_object(c, "$.ErrorMessage"), c)


def epoch_ms(col: Column | str) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(_c(col))


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    """Seconds between two timestamps, rounded to 3 places."""
    return F.round((F.unix_micros(_c(end).cast("timestamp"))
                    - F.unix_micros(_c(start).cast("timestamp"))) / F.lit(1e6), 3)


def int_or_zero(col: Column | str) -> Column:
    """NULL count as 0."""
    return F.coalesce(_c(col).cast("bigint"), F.lit(0).cast("bigint"))


def extract_pair(col: Column | str, pattern: str) -> tuple[Column, Column]:
    """Two captured numbers of a regex, as integers; no match gives NULLs."""
    c = strip(col)
    matched = c.rlike(pattern)
    low = F.when(matched, F.regexp_extract(c, pattern, 1).try_cast("int"))
    high = F.when(matched, F.regexp_extract(c, pattern, 2).try_cast("int"))
    return low, high


def matches(col: Column | str, pattern: str) -> Column:
    """Regex class test (L12); NULL input is not a match."""
    return F.coalesce(_c(col).rlike(pattern), F.lit(False))

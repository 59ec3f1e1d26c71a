"""Keys, identifiers and hashes.

The business identifier is ``S`` + 3 block digits + 2 digits of the group's
mean price + the month digits + the town's initial, e.g. ``S1243403A``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerflow.functions.text import strip

# Text standing for NULL inside a surrogate key, separator
# between key parts, and the identifier's prefix and length.
NULL_TOKEN = "<NA>"
KEY_SEPARATOR = "|"
IDENTIFIER_PREFIX = "S"
IDENTIFIER_LENGTH = 9


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def surrogate_key(cols: list[str]) -> Column:
    """sha256 hex of the key columns as text joined by ``|`` (L1).

    ``concat_ws`` alone skips NULLs, so a NULL part is written as a token
    of its own; a NULL and an empty part therefore hash differently.
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def sha256(col: Column | str) -> Column:
    """sha256 hex of the UTF-8 text (L2)."""
    return F.sha2(_c(col).cast("string"), 256)


def digits_prefix(col: Column | str, n: int = 3) -> Column:
    """First ``n`` ASCII digits of the text, left-padded with 0; no digit gives NULL (L3)."""
    digits = F.regexp_replace(_c(col).cast("string"), "[^0-9]", "")
    return F.when(digits != "", F.lpad(F.substring(digits, 1, n), n, "0"))


def mean_prefix(col: Column | str, n: int = 2) -> Column:
    """First ``n`` characters of the integer part of a number, left-padded (L4)."""
    whole = _c(col).cast("bigint").cast("string")
    return F.lpad(F.substring(whole, 1, n), n, "0")


def month_digits(col: Column | str) -> Column:
    """The part after the first ``-``, padded to two characters but never cut."""
    part = F.try_element_at(F.split(_c(col), "-"), F.lit(2))
    return F.lpad(part, F.greatest(F.lit(2), F.length(part)), F.lit("0"))


def initial(col: Column | str) -> Column:
    """Upper-cased first character of the trimmed text; empty gives NULL."""
    first = F.upper(F.substring(strip(col), 1, 1))
    return F.nullif(first, F.lit(""))


def build_identifier(parts: list[Column]) -> Column:
    """Prefix + parts, a NULL part counting as empty."""
    return F.concat(F.lit(IDENTIFIER_PREFIX), *[F.coalesce(p, F.lit("")) for p in parts])


def identifier_valid(parts: list[Column], identifier: Column) -> Column:
    """All parts present and the identifier has the expected length."""
    present = F.lit(True)
    for p in parts:
        present = present & p.isNotNull()
    return present & (F.length(identifier) == IDENTIFIER_LENGTH)


def missing(col: Column | str) -> Column:
    """NULL or empty text (C14)."""
    c = _c(col)
    return c.isNull() | (c == "")

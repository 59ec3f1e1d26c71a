"""Remaining lease as integer column arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: length of a lease in years.
LEASE_YEARS = 99


def _as_of_col(as_of: dt.date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def remaining_lease(year: Column | str, as_of: dt.date | str | Column | None = None,
                    term_years: int = LEASE_YEARS) -> tuple[Column, Column]:
    """(years, months) left of a lease that began in ``year``, as of a date.

    Months elapsed count the current month once the 1st has passed; the
    remainder never goes below zero. An unreadable year gives NULLs.
    """
    y = (F.col(year) if isinstance(year, str) else year).try_cast("bigint")
    d = _as_of_col(as_of)
    elapsed = ((F.year(d) - y) * 12 + (F.month(d) - 1)
               + F.when(F.dayofmonth(d) > 1, 1).otherwise(0))
    left = F.greatest(F.lit(term_years * 12).cast("bigint") - elapsed, F.lit(0).cast("bigint"))
    left = F.when(y.isNotNull(), left)
    return (F.floor(left / 12).cast("bigint"), (left % 12).cast("bigint"))

"""Row filters and per-group caps.

Month filters compare the parsed month; ``date_range`` also gives Spark a
plain text range on the month column (``YYYY-MM`` text sorts like the
month), which the Parquet scan can use against its min/max statistics
before the exact parse runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerflow.functions.text import month_date


def in_month_range(col: str, start: str, end: str) -> Column:
    """Month text parses and start <= month <= end (dates ``YYYY-MM-DD``)."""
    m = month_date(col)
    return m.isNotNull() & (m >= F.lit(start).cast("date")) & (m <= F.lit(end).cast("date"))


def date_range(df: DataFrame, col: str, start: str, end: str, prune: bool = True) -> DataFrame:
    """Rows whose month lies in the range.

    With ``prune`` a coarse text predicate is added first; it only keeps
    text starting with a year inside the range, so it never removes a row
    the exact test would keep, and it can be pushed into the scan.
    """
    out = df
    if prune:
        # the year after the last one is compared as text, so it must have four digits too
        out = out.where(F.col(col) >= F.lit(start[:4]))
        if end[:4] < "9999":
            out = out.where(F.col(col) < F.lit(f"{int(end[:4]) + 1:04d}"))
    return out.where(in_month_range(col, start, end))


def date_range_counts(df: DataFrame, col: str, start: str, end: str) -> DataFrame:
    """Rows kept and dropped by the month range, in one pass."""
    ok = in_month_range(col, start, end)
    return df.agg(F.count_if(ok).cast("bigint").alias("kept"),
                  F.count_if(~ok).cast("bigint").alias("dropped"))


def all_null(cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNull()
    return cond


def drop_blank(df: DataFrame) -> DataFrame:
    """Drop rows whose every column is NULL."""
    return df.dropna(how="all")


def overlap(manifest: DataFrame, start: str, end: str,
            start_col: str = "coverage_start", end_col: str = "coverage_end") -> DataFrame:
    """Manifest rows whose coverage overlaps [start, end]."""
    return manifest.where((F.col(start_col) <= F.lit(end).cast("date"))
                          & (F.col(end_col) >= F.lit(start).cast("date")))


def require_any(df: DataFrame, what: str) -> DataFrame:
    """Raise when a frame has no row (C3: no overlapping dataset is an error)."""
    if not df.limit(1).collect():
        raise RuntimeError(f"no {what} matched")
    return df


def cap_rows(df: DataFrame, n: int, by: list[str] | None, order: list[str | Column]) -> DataFrame:
    """First ``n`` rows per group in a declared order; ``n = 0`` keeps all.

    ``row_number() <= n`` is planned as a partial ``WindowGroupLimit``
    before the shuffle, so a large group is cut on the map side.
    """
    if n <= 0:
        return df
    if not by:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")

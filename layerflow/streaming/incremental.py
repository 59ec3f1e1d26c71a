"""Incremental windows, late rows and watermarks.

The window is decided on the driver from three scalars (load type,
watermark, lookback) that come from one-row lookups; the row filter it
produces is an ordinary predicate that reaches the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.plans.ledger import DEFAULT_WATERMARK
from layerflow.sources.store import TableStore, merge_frames

# Fixed value: default lookback in days.
LOOKBACK_DAYS = 7


def effective_window(load_type: str | None, watermark: str | None, start: str, end: str,
                     lookback_days: int = LOOKBACK_DAYS, months: bool = False) -> tuple[dt.date, dt.date]:
    """Window to (re)load (K2).

    FULL -> whole range. Otherwise the watermark minus the lookback, but
    never before the range start; with ``months``, for rows that are known by
    their month, the first day of that month; an empty or default watermark means the
    whole range.
    """
    first, last = dt.date.fromisoformat(start[:10]), dt.date.fromisoformat(end[:10])
    mark = (watermark or "").strip()
    incremental = (load_type or "FULL").strip().upper() != "FULL"
    if incremental and mark and mark[:10] != DEFAULT_WATERMARK[:10]:
        reach = dt.datetime.fromisoformat(mark).date() - dt.timedelta(days=lookback_days)
        first = max(first, reach.replace(day=1) if months else reach)
    return first, last


def window_filter(col: str | Column, window: tuple[dt.date, dt.date]) -> Column:
    """Rows whose time lies inside the window (end day inclusive)."""
    c = F.col(col) if isinstance(col, str) else col
    lo = F.lit(window[0].isoformat()).cast("timestamp")
    hi = F.lit((window[1] + dt.timedelta(days=1)).isoformat()).cast("timestamp")
    return (c >= lo) & (c < hi)


def incremental_merge(batch: DataFrame, time_col: str, window: tuple[dt.date, dt.date],
                      store: TableStore, stage: str, key: str):
    """Re-read rows inside the window and upsert them; older rows are left alone (K3)."""
    return store.merge(batch.where(window_filter(time_col, window)), stage, key)


def late_rows_merge(target: DataFrame, batch: DataFrame, time_col: str,
                    window: tuple[dt.date, dt.date], key: str) -> DataFrame:
    """Frame form of K3: target upserted with the batch rows inside the window."""
    return merge_frames(target, batch.where(window_filter(time_col, window)), key)


def advance_watermark(marks: DataFrame, updates: DataFrame, load_type: str, succeeded: bool) -> DataFrame:
    """Watermark rows after a run.

    Only a successful non-FULL run moves the watermark; ``updates`` holds
    (table_id, last_watermark_value, last_run_id, last_updated_at) and is
    merged on ``table_id``.
    """
    if not succeeded or (load_type or "FULL").strip().upper() == "FULL":
        return marks
    return merge_frames(marks, updates.select(*[c for c in marks.columns if c in updates.columns]), "table_id")


def max_event_time(df: DataFrame, time_col: str) -> DataFrame:
    """New watermark value: the latest event time processed (D14), as text."""
    return df.agg(F.date_format(F.max(time_col), "yyyy-MM-dd HH:mm:ss").alias("last_watermark_value"))

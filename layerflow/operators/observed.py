"""Counts gathered by the write itself (B9, B12, C1): no second read of what was written.

``write_observed`` puts an ``Observation`` right above the write, so its aggregates are worked out over the rows
as the tasks hand them to the files. The plan below may shuffle as it likes: the observed rows are those of the write's own
stage, whose tasks count once each, however often one is retried. Only the totals (one row) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from layerflow.session import freed_shuffles

ROWS = "rows"


def per_value(column: str, values: list[str] | tuple[str, ...], prefix: str = "") -> dict[str, Column]:
    """One count for each of a fixed list of values of ``column``."""
    return {f"{prefix}{v}": F.count_if(F.col(column) == F.lit(v)) for v in values}


def write_observed(df: DataFrame, path: str, partition_by: list[str] | tuple[str, ...] = (), metrics: dict[str, Column] | None = None,
                   mode: str = "errorifexists") -> dict[str, int]:
    """Write ``df`` as Parquet and return its number of rows (``rows``) and the other ``metrics``, aggregates by name.

    An empty frame gives 0 rows, counts of 0 and sums of null. A write that fails raises, and gives no counts.
    """
    seen = Observation()
    wanted = {ROWS: F.count(F.lit(1)), **(metrics or {})}
    writer = df.observe(seen, *[c.alias(name) for name, c in wanted.items()]).write.mode(mode).option("compression", "zstd")
    with freed_shuffles(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return dict(seen.get)

"""Folders present on storage but unknown to the catalog.

The listing is a ``binaryFile`` scan that selects only ``path`` (file
contents are never read). Folder names are compared with the known table
locations by anti-join; the result is a report, nothing is deleted.
"""

from __future__ import annotations

import re
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.operators.setops import difference


def top_folders(spark: SparkSession, root: str) -> DataFrame:
    """Distinct first-level folder names under ``root`` that hold files."""
    root = root.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(root).select("path"))
    rel = F.regexp_replace(F.col("path"), r"^.*?" + re.escape(root) + "/", "")
    return files.select(F.split(rel, "/").getItem(0).alias("name")).where(
        F.col("name") != "").distinct()


def orphans(spark: SparkSession, root: str, known: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """Folders under ``root`` that are neither known tables nor allow-listed."""
    return difference(top_folders(spark, root), known, allow, on="name")

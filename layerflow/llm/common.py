"""Helpers shared by the operators: code shipping, shared work folders, bucket counts.

Intermediate tables go to a fresh folder under the one the session names in
``spark.checkpoint.dir`` (all executors see it), so a lost executor re-reads
files instead of recomputing. The folder's scheme is kept as given.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()
#: Characters that separate words; as a character class, and as the characters themselves.
SPACES = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="code-"), "layerflow_code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def work_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables, on shared storage.

    A private folder is made only for a local master without the setting, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-work-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-work/{spark.sparkContext.applicationId}"


CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back (a lineage cut).

    Spark deletes the write's shuffle files when it is done: what is read from now on are the table's files.
    """
    spark = df.sparkSession
    path = f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(CLEAN_SHUFFLES)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.work_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete written tables (see ``written``) that no table to come is made from."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.work_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def drop_work(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call when its results are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


BROADCAST_BYTES = 8 << 20  # a table whose counted size is below this is broadcast, a larger one is shuffled


def small(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """``df`` marked for broadcast if its size, counted from ``row_bytes`` of every row, is below the bound."""
    total = df.agg(F.sum(row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes))).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` but those of ``dropped`` (doc_id, text_hash); rows without a doc_id stay."""
    keys = written(dropped.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "dropped")
    return docs.join(small(keys, 16), (docs["doc_id"] == keys["_id"]) & (F.xxhash64(text_or_empty()) == keys["_hash"]), "left_anti")


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of an ASCII string, bit by bit."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda ch: list_transform(range(8), lambda i: CAST((ascii(ch) >> CAST(i AS INTEGER)) & 1 AS BIGINT))))"
    step = "xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {bits}), lambda c, b: {step}), CAST(4294967295 AS BIGINT))"

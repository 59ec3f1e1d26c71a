"""Session settings and the shared scratch folder.

Everything that is written between steps (staged snapshots, landed CSV,
stream checkpoints) lives under the folder the cluster names in
``spark.checkpoint.dir``. That folder is shared by all executors, so a job
that loses an executor can still read what was written before. A private
folder is only created when the setting is missing, as in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a layer job relies on. AQE re-plans joins from runtime sizes
# (broadcast only when the built side really is small, split skewed
# partitions otherwise); the session zone is pinned so that timestamps
# print the same on every machine.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "layerflow",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench; a cluster passes its own settings."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = tempfile.mkdtemp(prefix="layerflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    if root.startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root, "layerflow", *parts, uuid.uuid4().hex)


CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of a write inside this block when the write is done: its result is read from the table's files."""
    before = spark.conf.get(CLEAN_SHUFFLES)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


def written_once(spark: SparkSession, *parts: str) -> Callable[[DataFrame], DataFrame]:
    """A reuse hook for plans outside a runner: each frame is written to a folder of its own and read back."""
    def write(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, *parts)
        with freed_shuffles(df.sparkSession):
            df.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)
    return write

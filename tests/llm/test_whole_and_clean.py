"""Learning from all rows, and what the operators leave on the disk."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from layerflow.llm import license_scan, merkle, suffix_dedup
from layerflow.llm.common import work_root, written


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(k).getName() for k in range(files.size())) if name.startswith("shuffle_")}


def _tables(spark) -> set[str]:
    root = work_root(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_licences_learn_from_every_paragraph(spark, monkeypatch):
    """every paragraph without a pair of a template counts, in training and for the threshold."""
    rows = [(i, f"entry {i} about the weather\nnew software for office {i}\n\nAll rights reserved.", i) for i in range(2_500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key long")
    seen = {}
    monkeypatch.setattr(license_scan, "written", lambda df, name: seen.setdefault(name, written(df, name)))
    scanner = license_scan.train(frame)
    learnt = seen["licence-rows"].filter("label = 0")
    assert learnt.agg(F.sum("n")).first()[0] == 5_000 + len(license_scan.OTHERS)
    assert abs(learnt.agg(F.sum("weight")).first()[0] - license_scan.UNKNOWN_WEIGHT - len(license_scan.OTHERS)) < 1e-6
    monkeypatch.undo()
    got = license_scan.scan(frame.select("doc_id", "text"), scanner).groupBy("n_licences", "families").count().collect()
    assert [tuple(r) for r in got] == [(1, "proprietary", 2_500)]


def test_written_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    table = written(spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")), "sevens")
    assert table.count() == 7
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    left = {name for name in _shuffle_files(spark) - before if name.endswith(".data")}
    assert len(left) <= 1  # of count() alone, not of the write


def test_passages_and_manifest_free_their_work(spark):
    passage = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(i, f"{'abc' * i} {passage} {i}", "en", "s", 10) for i in range(12)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    before = _tables(spark)
    assert suffix_dedup.remove_repeats(docs).filter("n_removed > 400").count() == 12
    assert merkle.manifest(docs).count() == 12
    left = {name.rsplit("-", 1)[0] for name in _tables(spark) - before}
    assert not left & {"anchors", "shared", "units", "unit-bytes", "leaves"} and "spans" in left

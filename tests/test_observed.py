"""Counts observed by writes, and the ledger's rows, status and totals made from audit rows."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from layerflow.operators.observed import per_value, write_observed
from layerflow.plans import ledger


def test_counts_are_those_of_the_files_and_take_no_job(spark, scratch):
    """With a shuffle below, an empty frame, partitions and nulls; one write job, no more."""
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("s"))
    for name, frame in {"plain": df, "shuffled": df.repartition(5, "k"), "few": df.limit(0), "none": df.where("k > 9"), "grouped": df.distinct()}.items():
        path = os.path.join(scratch, name)
        seen = write_observed(frame, path, ["k"] if name != "none" else [], {"null_s": F.count_if(F.col("s").isNull()), **per_value("s", ["a", "b"])})
        back = spark.read.schema("s string, k bigint").parquet(path)
        want = back.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("s").isNull()).alias("null_s"),
                        F.count_if(F.col("s") == "a").alias("a"), F.count_if(F.col("s") == "b").alias("b")).first().asDict()
        assert seen == want
    sc = spark.sparkContext
    sc.setJobGroup("observed-write", "one write")
    try:
        write_observed(df, os.path.join(scratch, "jobs"))
        assert len(sc.statusTracker().getJobIdsForGroup("observed-write")) == 1
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def _audit(spark):
    at = dt.datetime(2024, 1, 15, 12)
    rows = [("u1", "raw_layer", "raw", 9, 9, 0, at, 1.5), ("u2", "cleaned_layer", "cleaned", 9, 0, 9, at, None),
            ("u3", "raw_layer", "raw", 5, 5, 0, at - dt.timedelta(days=9), 1.0), ("u4", "other", "x", 1, 1, 0, at, 1.0), ("u1", "raw_layer", "raw", None, None, None, None, None)]
    return spark.createDataFrame(rows, ledger.AUDIT_SCHEMA)


JOBS = {"raw_layer": "raw", "cleaned_layer": "cleaned", "hashed_layer": "hashed"}


def test_ledger_rows_are_whole_and_synced_once(spark):
    audit = _audit(spark)
    out = ledger.ledger_rows(audit, "2024-01-15 00:00:00", JOBS, 3)
    assert out.columns == [f.name for f in ledger.RUNS_SCHEMA.fields]
    got = {r.layer: r for r in out.collect()}
    assert set(got) == {"raw", "cleaned"}
    assert (got["raw"].status, got["raw"].number_of_records, got["raw"].error_message) == (ledger.SUCCEEDED, 9, None)
    assert (got["raw"].end_time - got["raw"].start_time).total_seconds() == 1.5
    assert (got["cleaned"].status, got["cleaned"].error_message) == (ledger.EMPTY, "cleaned_layer kept no rows")
    assert got["cleaned"].start_time == got["cleaned"].end_time
    assert ledger.ledger_rows(audit, "2024-01-15 00:00:00", JOBS, 3, out).count() == 0
    assert ledger.ledger_rows(audit.limit(0), "2024-01-15 00:00:00", JOBS, 3).count() == 0


def test_status_and_totals(spark):
    status = ledger.job_status(_audit(spark), JOBS, "2024-01-15 00:00:00")
    assert {r.job_name: (r.status, r.runs, r.records, r.rejected) for r in status.collect()} == {
        "raw_layer": (ledger.SUCCEEDED, 1, 9, 0), "cleaned_layer": (ledger.EMPTY, 1, 0, 9), "hashed_layer": (ledger.NOT_RUN, 0, 0, 0)}
    assert tuple(ledger.run_totals(status).first()) == (3, 1, 1, 2, 9, 1.5)
    assert {r.status for r in ledger.job_status(_audit(spark).limit(0), JOBS).collect()} == {ledger.NOT_RUN}

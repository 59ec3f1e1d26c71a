"""Ingest as a recorded stage; required parameters."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from layerflow.plans import layers as L
from layerflow.plans import ledger
from layerflow.plans.run import RUNS, Runner
from layerflow.sources.store import TableStore


def test_ingest_records_matched_and_landed(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "store"))
    day = dt.date
    manifest = spark.createDataFrame(
        [("a", day(2010, 1, 1), day(2012, 6, 30)), ("b", day(2013, 1, 1), day(2014, 12, 31)), ("c", day(2020, 1, 1), day(2021, 1, 1))],
        "dataset_id string, coverage_start date, coverage_end date")
    landed = spark.createDataFrame([("a", 7), ("c", 5)], "dataset_id string, rows bigint")
    run = Runner(spark, store, L.LayerSpec(range_start="2012-01-01", range_end="2016-12-31"))
    assert sorted((r.dataset_id, r.rows_landed) for r in run.ingest(manifest, landed).collect()) == [("a", 7), ("b", 0)]
    with pytest.raises(RuntimeError, match="dataset of the manifest"):
        Runner(spark, store, L.LayerSpec(range_start="1990-01-01", range_end="1991-12-31")).ingest(manifest, landed)
    rows = store.read(RUNS).orderBy("run_id").collect()
    assert [(r.layer, r.status, r.number_of_records) for r in rows] == [
        ("ingest", ledger.SUCCEEDED, 7), ("ingest", ledger.FAILED, 0)]
    assert rows[0].error_message == "1 of 2 matched datasets landed"


def test_required_parameters(spark):
    tables = spark.createDataFrame([(1,), (2,)], "table_id bigint")
    params = spark.createDataFrame([(1, "load_type", "FULL"), (2, "load_type", None), (1, "lookback", "7")],
                                   "table_id bigint, parameter_name string, parameter_value string")
    got = ledger.missing_parameters(tables, params, ["load_type", "lookback"]).collect()
    assert sorted(map(tuple, got)) == [(2, "load_type"), (2, "lookback")]
    ledger.require_parameters(tables.where("table_id = 1"), params, ["load_type", "lookback"])
    with pytest.raises(ValueError, match="load_type of table 2, lookback of table 2"):
        ledger.require_parameters(tables, params, ["load_type", "lookback"])

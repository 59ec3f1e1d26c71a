"""Ledger scenarios with the counts of the recorded runs (FIXTURES section 4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from layerflow.plans import ledger

LAYERS = ["source", "raw", "cleaned", "transformed", "hashed"]
T0 = dt.datetime(2026, 9, 1, 17, 0, 0)


def _runs(spark, counts, statuses=None):
    rows = []
    for i, (layer, n) in enumerate(zip(LAYERS, counts)):
        st = (statuses or {}).get(layer, ledger.SUCCEEDED)
        rows.append((i + 1, 1, layer, T0 + dt.timedelta(minutes=i), T0 + dt.timedelta(minutes=i, seconds=30), st, n, None))
    return spark.createDataFrame(rows, ledger.RUNS_SCHEMA)


def _rejects(spark, per_layer):
    rows = [(LAYERS.index(layer) + 1, layer, n) for layer, n in per_layer.items()]
    return spark.createDataFrame(rows, "run_id bigint, layer string, rejected bigint")


def _outcome(spark, runs, rejects, tables=None):
    rep = ledger.reconcile_report(runs, rejects, LAYERS, tables)
    return rep, ledger.report_outcome(rep).collect()[0]


def test_large_run_reconciles(spark):
    runs = _runs(spark, [92544, 92544, 89641, 76167, 76167])
    rej = _rejects(spark, {"cleaned": 1595 + 1307 + 1, "transformed": 13474})
    rep, out = _outcome(spark, runs, rej)
    assert out.all_reconciled and out.stopped_at is None
    chain = ledger.count_chain(runs, LAYERS).collect()[0]
    assert (chain.retained_pct, chain.quarantined_pct) == (82.3, 17.7)


def test_small_run_reconciles(spark):
    runs = _runs(spark, [50, 50, 42, 41, 41])
    rej = _rejects(spark, {"cleaned": 4 + 2 + 2, "transformed": 1})
    _, out = _outcome(spark, runs, rej)
    assert out.all_reconciled
    assert ledger.count_chain(runs, LAYERS).collect()[0].retained_pct == 82.0


def test_nothing_run_stops_at_first_layer(spark):
    runs = spark.createDataFrame([], ledger.RUNS_SCHEMA)
    tables = spark.createDataFrame([(1,)], "table_id bigint")
    _, out = _outcome(spark, runs, _rejects(spark, {}), tables)
    assert out.stopped_at == "source" and not out.all_reconciled


def test_broken_run_stops_at_cleaned_with_gap_one(spark):
    runs = _runs(spark, [50, 50, 41, 41, 41])
    rej = _rejects(spark, {"cleaned": 8, "transformed": 0})
    rep, out = _outcome(spark, runs, rej)
    assert out.stopped_at == "cleaned"
    row = rep.where(F.col("layer") == "cleaned").collect()[0]
    assert row.expected - (row.kept + row.rejected) == 1
    later = rep.where(F.col("layer").isin("transformed", "hashed")).collect()
    assert all(not r.evaluated for r in later)


def test_latest_and_next_run(spark):
    runs = _runs(spark, [5, 5, 4, 4, 4])
    assert ledger.next_run_id(runs).collect()[0].next_run_id == 6
    last = ledger.latest_run(runs, ["table_id"]).collect()[0]
    assert last.layer == "hashed"


def test_read_ledger_missing_tables_give_empty_frames(spark, scratch):
    from layerflow.sources.store import TableStore
    frames, errors = ledger.read_ledger(TableStore(spark, scratch))
    assert set(frames) == set(ledger.LEDGER_SCHEMAS) and not errors
    assert all(f.count() == 0 for f in frames.values())
    assert frames["pipeline_runs"].schema == ledger.RUNS_SCHEMA


def test_bucketed_range_join_matches_brute_force(spark):
    """The bucketed reject-window join equals the plain stage equi-join + range filter."""
    from layerflow.plans import fixtures as X
    from layerflow.plans.q_ledger import _failed_events
    sf = "/root/testdata/sf0.001"
    runs = X.runs_from_events(spark, sf)
    failed = _failed_events(spark, sf)
    fast = ledger.rejects_in_window(failed, runs, slack_seconds=1, bucket_seconds=60)
    slow = ledger.rejects_in_window_naive(failed, runs, slack_seconds=1)
    assert sorted(fast.collect()) == sorted(slow.collect())
    # the run side too large to broadcast: pre-aggregated rejects into a sort-merge join
    merged = ledger.rejects_in_window(failed, runs, slack_seconds=1, bucket_seconds=60, max_rows=0)
    assert sorted(merged.collect()) == sorted(slow.collect())


def test_compaction_keeps_rows(spark, scratch):
    from layerflow.sources.store import TableStore
    st = TableStore(spark, scratch)
    for i in range(5):
        st.append(spark.createDataFrame([(i,)], "x long"), "log", rows=1)
    assert st.compact("log", max_segments=3)
    assert len(st.current("log").segments) == 1
    assert sorted(r.x for r in st.read("log").collect()) == list(range(5))

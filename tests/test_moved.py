"""What the layers move and write: narrow work tables, segments published as they are, checks by bucket."""

from __future__ import annotations

import glob
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from layerflow.operators.dedup import losers
from layerflow.operators.setops import partition_check
from layerflow.plans import fixtures, layers as L
from layerflow.plans import q_sources
from layerflow.plans.run import GateError, REASON, Runner
from layerflow.sources.store import TableStore
from tests.test_delta_layers import COLUMNS, MONTHS, SPEC, frame, same, transactions


def test_work_tables_of_the_layers_are_narrow(spark, scratch):
    """The rows of a layer are not copied into work tables, nor shuffled whole to find the best of each key."""
    runner = Runner(spark, TableStore(spark, scratch), SPEC)
    runner.raw(frame(spark, transactions(3, 80, ["BEDOK"], MONTHS)))
    seen = []

    def reuse(df):
        seen.append((df.columns, df.count()))
        return runner._written("cleaned")(df)
    L.tag_cleaned(runner.read_layer("raw"), SPEC, reuse, check_small=True).count()
    wide = [n for cols, n in seen if set(COLUMNS[:4]) <= set(cols)]
    assert max(wide, default=0) < 80  # only rows whose key may repeat go whole


def test_losers_by_hash_equal_a_count_of_whole_keys(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([0.0, -0.0, float("nan"), None, 1.5]), rng.choice([1.0, 2.0, None])) for i in range(60)]
    df = spark.createDataFrame(rows, "_rid int, k string, d double, p double")
    hashed = df.select("_rid", F.xxhash64("k", "d").alias("_kh"))
    got = {r[0] for r in losers(df, hashed, ["k", "d"], ["p", "_rid"], "_rid", "_kh", lambda x: x).collect()}
    best = {}
    for i, k, d, p in rows:
        key = (k, "nan" if d is not None and d != d else d)
        best[key] = max(best.get(key, ((False, 0.0), -1)), ((p is not None, p or 0.0), i))
    assert got == set(range(60)) - {i for _, i in best.values()}


def test_merged_runs_publish_what_is_written(spark, scratch):
    """Months that a run doesn't touch stay where they are, and a layer judged whole is not written a second time."""
    store, stages = TableStore(spark, os.path.join(scratch, "s")), []
    for i, m in enumerate(MONTHS[:2]):
        Runner(spark, store, SPEC, load_type="MERGE").all_layers(frame(spark, transactions(i, 40, ["BEDOK"], [m])), 40)
        stages.append({s: store.current(s).segments for s in ("raw", "cleaned", "transformed")})
    assert stages[1]["raw"][0] == stages[0]["raw"][0] and len(stages[1]["raw"]) == 2
    assert all("_status=kept" in s for stage in ("raw", "cleaned", "transformed") for s in stages[1][stage])
    again = transactions(9, 30, ["Clementi"], [MONTHS[0]])
    want = same(store.read("raw").where(F.col("month") == MONTHS[1]), COLUMNS) + same(frame(spark, again), COLUMNS)
    Runner(spark, store, SPEC, load_type="MERGE").all_layers(frame(spark, again), 30)
    assert same(store.read("raw"), COLUMNS) == sorted(want, key=repr) and store.count("raw") == len(want)


def test_partition_check_counts_differences_row_by_row(spark, capsys):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice([None, 1, 2]), rng.choice([None, 0.5])) for _ in range(50)]
    for kept, rej in ((rows[:20], rows[20:]), (rows[:20], rows[23:]), (rows, rows[:5]), ([], []), (rows[:20], rows[20:-1] + [("z", 1, 0.5)])):
        a, b, c = (spark.createDataFrame(r, "a string, b int, c double") for r in (rows, kept, rej))
        d = Counter(rows)
        d.subtract(Counter(kept + rej))
        want = (50, len(kept), len(rej), sum(v for v in d.values() if v > 0), -sum(v for v in d.values() if v < 0))
        assert [tuple(r) for r in partition_check(a, b, c).collect()] == [want]
    empty = spark.createDataFrame([], "a string")
    assert tuple(partition_check(empty, empty, empty).first()) == (None,) * 5
    partition_check(a, b, c).explain()
    assert "_bk" in capsys.readouterr().out


def test_line_items_are_joined_alike_at_every_size(spark):
    plan = fixtures.tx(spark, "/root/testdata/sf0.001", row_id=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin [l_orderkey") == 1 and plan.count("SortMergeJoin [l_partkey") == 1


def test_a_layer_that_the_gate_stops_is_not_written_twice(spark, scratch):
    """Its rows go to quarantine where they were staged, with the gate's reason; later appends leave that reason alone."""
    root = os.path.join(scratch, "s")
    store = TableStore(spark, root)
    with pytest.raises(GateError) as stopped:
        Runner(spark, store, SPEC).raw(frame(spark, transactions(3, 40, ["BEDOK"], MONTHS)), 41)
    assert not os.path.exists(os.path.join(root, "failed", "data")) and store.count("failed") == 40 and not store.exists("raw")
    store.append(spark.createDataFrame([("other",)], f"{REASON} string"), "failed")
    for view in (store, TableStore(spark, root)):
        got = Counter(r[0] for r in view.read("failed").select(REASON).collect())
        assert got == {str(stopped.value): 40, "other": 1}


def test_work_tables_go_when_their_layer_is_written(spark, scratch):
    Runner(spark, TableStore(spark, scratch), SPEC).all_layers(frame(spark, transactions(3, 60, ["BEDOK"], MONTHS)), 60)
    assert not glob.glob(os.path.join(scratch, "**", "work-*"), recursive=True)


def test_the_streamed_chain_lands_compressed_files(spark, monkeypatch):
    seen = []

    def land(df, path, **options):
        seen.append(options)
        raise InterruptedError
    monkeypatch.setattr(q_sources.csvsrc, "land_csv", land)
    with pytest.raises(InterruptedError):
        q_sources.q_stream_layers(spark, "/root/testdata/sf0.001")
    assert seen == [{"compression": "gzip"}]

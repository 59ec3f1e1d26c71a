"""Layers kept up by deltas, and merged layers with retractions, against one full run."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from layerflow.plans import layers as L
from layerflow.plans import ledger
from layerflow.plans.run import Runner
from layerflow.schema import RAW_SCHEMA
from layerflow.sources.csv import land_csv
from layerflow.sources.store import TableStore, merge_frames
from layerflow.streaming.delta_layers import DeltaLayers, stream_delta_layers

COLUMNS = [f.name for f in RAW_SCHEMA.fields]
SPEC = L.LayerSpec(as_of="2024-01-31", category_k=4, tiebreak=[])


def transactions(seed: int, n: int, towns: list[str], months: list[str], dirty: float = 0.15) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        bad = rng.random() < dirty
        out.append((rng.choice(months), rng.choice(towns) if not bad or rng.random() < 0.5 else f"rare {rng.randrange(3)}",
                    rng.choice(["3 ROOM", "4 ROOM"]), f"{rng.randrange(30):03d}", " main st ", "04 TO 06" if not bad or rng.random() < 0.7 else "x",
                    90.0 if not bad or rng.random() < 0.7 else 5.0, rng.choice(["Model A", "model b", "C"]), 1990,
                    float(rng.choice([300_000, 310_000, 320_000, 330_000]) + (3_000_000 if bad and rng.random() < 0.3 else i))))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def same(df, names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def layer_names(runner, stage):
    return [c for c in runner.store.read(stage).columns if not c.startswith("_")]


MONTHS = ["2015-01", "2015-02", "2015-03"]


@pytest.fixture(scope="module")
def batches():
    first = transactions(1, 160, ["ang mo kio", "BEDOK", "Clementi"], MONTHS)
    second = transactions(2, 60, ["BEDOK", "rare 0"], MONTHS[1:]) + [(None,) * len(COLUMNS), ("2011-12", *first[0][1:])]
    third = [(*r[:9], r[9] + 7_000.0) for r in first if r[1] == "BEDOK"][:20]  # better prices for known keys
    return [first, second, third]


@pytest.fixture(scope="module")
def full(spark, batches, tmp_path_factory):
    runner = Runner(spark, TableStore(spark, str(tmp_path_factory.mktemp("full"))), SPEC)
    runner.all_layers(frame(spark, sum(batches, [])))
    return runner


def test_deltas_end_where_a_full_run_ends(spark, scratch, batches, full):
    layers = DeltaLayers(spark, os.path.join(scratch, "delta"), SPEC, buckets=16)
    for i, rows in enumerate(batches):
        layers.apply(frame(spark, rows), f"b{i}")
    for stage in ("raw", "cleaned", "transformed", "hashed"):
        names = [c for c in layer_names(full, stage) if c != L.SURROGATE or stage != "raw"]
        assert same(layers.layer(stage), names) == same(full.store.read(stage), names), stage
    want = ledger.reject_counts(full.store.read("failed"))
    assert same(layers.rejected(), ["stage", "reason", "rejected"]) == same(want, ["stage", "reason", "rejected"])
    # the work of a batch follows what it touches
    total = layers.layer("raw").count()
    last = layers.stats[-1]
    assert last.rows == len(batches[2])
    assert len(last.buckets) <= 2 and last.landed_read < total / 2


def test_a_replayed_batch_changes_nothing(spark, scratch, batches):
    layers = DeltaLayers(spark, os.path.join(scratch, "delta"), SPEC, buckets=8)
    for i, rows in enumerate(batches[:2]):
        layers.apply(frame(spark, rows), f"b{i}")
    before = {s: same(layers.layer(s), layers.layer(s).columns) for s in ("raw", "cleaned", "hashed")}
    layers.apply(frame(spark, batches[1]), "b1")
    assert before == {s: same(layers.layer(s), layers.layer(s).columns) for s in before}


def test_a_batch_that_failed_half_way_is_made_good(spark, scratch, batches, monkeypatch):
    """A batch dies after its identifier table was staged; its replay ends where an undisturbed run ends."""
    layers = DeltaLayers(spark, os.path.join(scratch, "delta"), SPEC, buckets=8)
    calm = DeltaLayers(spark, os.path.join(scratch, "calm"), SPEC, buckets=8)
    for i, rows in enumerate(batches[:2]):
        calm.apply(frame(spark, rows), f"b{i}")
    layers.apply(frame(spark, batches[0]), "b0")
    write = DeltaLayers._replace

    def dies(self, df, table, *by):
        if table == "candidates":
            raise RuntimeError("executor lost")
        write(self, df, table, *by)

    monkeypatch.setattr(DeltaLayers, "_replace", dies)
    with pytest.raises(RuntimeError, match="executor lost"):
        layers.apply(frame(spark, batches[1]), "b1")
    monkeypatch.setattr(DeltaLayers, "_replace", write)
    layers.apply(frame(spark, batches[1]), "b1")
    for stage in ("cleaned", "transformed", "hashed"):
        assert same(layers.layer(stage), calm.layer(stage).columns) == same(calm.layer(stage), calm.layer(stage).columns)


def test_rows_of_a_batch_are_not_copied_into_work_tables(spark, scratch, batches):
    layers = DeltaLayers(spark, os.path.join(scratch, "delta"), SPEC, buckets=8)
    layers.apply(frame(spark, batches[0]), "b0")
    work = os.path.join(scratch, "delta", "_work", "b0")
    tables = {t: spark.read.parquet(os.path.join(work, t)) for t in os.listdir(work)}
    assert tables and not [t for t, df in tables.items() if {"street_name", "block"} <= set(df.columns) and df.count()]


def test_compressed_files_are_streamed(spark, scratch, batches):
    land = os.path.join(scratch, "land")
    landed = frame(spark, batches[0])
    land_csv(landed.withColumn("dataset_id", F.lit("a")), land, compression="gzip")
    names = [n for _, _, files in os.walk(land) for n in files if ".csv" in n and not n.startswith(".")]
    assert names and all(n.endswith(".csv.gz") for n in names)
    land_csv(landed.limit(3).withColumn("dataset_id", F.lit("b")), os.path.join(land, "plain"))
    layers = DeltaLayers(spark, os.path.join(scratch, "delta"), SPEC, buckets=8)
    stream_delta_layers(spark, land, RAW_SCHEMA, os.path.join(scratch, "ckpt"), layers).awaitTermination(300)
    assert layers.layer("raw").count() == len(batches[0]) + 3


def test_a_batch_without_rows_in_range(spark, scratch):
    layers = DeltaLayers(spark, os.path.join(scratch, "delta"), SPEC)
    assert layers.apply(frame(spark, [(None,) * len(COLUMNS)]), "b0") is None
    assert layers.apply(frame(spark, []), "b1") is None


# ---------------------------------------------------------------- retractions

@pytest.mark.parametrize("broadcast", [False, True])
def test_merge_with_deletes(spark, broadcast):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], "k int, v string, old int")
    batch = spark.createDataFrame([(2, "B", 9), (4, "D", 9)], "k int, v string, new int")
    deletes = spark.createDataFrame([(1,), (2,), (1,), (7,)], "k int")
    out = merge_frames(target, batch, "k", broadcast, deletes)
    assert same(out, ["k", "v", "old", "new"]) == [(2, "B", 1, 9), (3, "c", 1, None), (4, "D", None, 9)]


@pytest.mark.parametrize("partition_by", [None, "month"])
def test_merged_runs_end_where_a_full_run_ends(spark, scratch, partition_by):
    """Months come one after another; a row that was kept and is an outlier later leaves every layer."""
    months = [transactions(i, 60, ["ang mo kio", "BEDOK"], [m]) for i, m in enumerate(MONTHS)]
    spec = L.LayerSpec(as_of="2024-01-31", category_k=4, partition_by=partition_by)
    store = TableStore(spark, os.path.join(scratch, "merged"))
    gone = 0
    for rows in months:
        had = None if store.read("cleaned") is None else store.read("cleaned").select(L.SURROGATE).distinct()
        runner = Runner(spark, store, spec, load_type="MERGE")
        runner.all_layers(frame(spark, rows), len(rows))
        if had is not None:
            had = frozenset(r[0] for r in had.collect())
        now = {r[0] for r in store.read("cleaned").select(L.SURROGATE).collect()}
        gone += 0 if had is None else len(had - now)
    one = Runner(spark, TableStore(spark, os.path.join(scratch, "one")), spec)
    one.all_layers(frame(spark, sum(months, [])))
    for stage in ("raw", "cleaned", "transformed", "hashed"):
        names = layer_names(one, stage)
        assert same(store.read(stage), names) == same(one.store.read(stage), names), stage
    runs, failed = store.read("pipeline_runs"), store.read("failed")
    rejected = ledger.rejects_in_window(failed, runs, slack_seconds=0).groupBy("run_id").agg(F.sum("rejected").alias("rejected"))
    report = ledger.reconcile_report(runs, rejected, ["source", "raw", "cleaned", "transformed", "hashed"]).collect()
    assert all(r.reconciled for r in report)
    assert {r.layer: r.kept for r in report}["raw"] == 60 and {r.layer: r.table_total for r in report}["raw"] == 180


def test_an_empty_batch_publishes_nothing(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "empty"))
    res = Runner(spark, store, SPEC, load_type="MERGE").raw(frame(spark, []), 0)
    assert (res.kept, res.rejected) == (0, 0) and not store.exists("raw")

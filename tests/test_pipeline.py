"""Full layer chain over hand-written transaction CSV files (FIXTURES 1.1) and properties."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from layerflow.operators.dedup import dedup_keep_max, file_row_id
from layerflow.operators.setops import partition_check
from layerflow.plans import layers as L
from layerflow.plans import ledger
from layerflow.plans.run import GateError, Runner
from layerflow.schema import RAW_SCHEMA
from layerflow.sources import csv as csvsrc
from layerflow.sources.store import TableStore

HEADER = "month,town,flat_type,block,street_name,storey_range,floor_area_sqm,flat_model,lease_commence_date,resale_price"


def _good_rows(town: str, n: int, price0: int) -> list[str]:
    return [f"2015-03,{town},4 ROOM,{100 + i:03d},MAIN ST,04 TO 06,90,Model A,1990,{price0 + 1000 * i}"
            for i in range(n)]


def _write(path: str, header: str, rows: list[str]) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(header + "\n" + "\n".join(rows) + "\n")


def _landing(root: str) -> str:
    land = os.path.join(root, "landing")
    a = _good_rows("ang mo kio", 6, 300000)
    a.append("2015-03,ANG MO KIO,4 ROOM,100,MAIN ST,04 TO 06,90,Model A,1990,250000")  # lower-price duplicate
    a.append(",,,,,,,,,")  # fully blank row
    a.append("2015-03,ANG MO KIO,4 ROOM,100,MAIN ST,04 TO 06,90,Model A,1990,250000")  # exact copy
    a.append("2011-12,ANG MO KIO,4 ROOM,007,MAIN ST,04 TO 06,90,Model A,1990,300000")  # outside the range
    _write(f"{land}/auto/dataset_id=a/x.csv", HEADER, a)
    b = [r + ",extra" for r in _good_rows("BEDOK", 6, 400000)]
    b.append("2015-04,BEDOK,4 ROOM,12A,MAIN ST,4 TO 6,10,Model A,2020,0,extra")  # fails several rules
    _write(f"{land}/auto/dataset_id=b/y.csv", HEADER + ",note", b)
    _write(f"{land}/manual/z.csv", HEADER, _good_rows("BEDOK", 2, 500000))
    return land


def test_chain_reconciles_and_quarantines(spark, scratch):
    land = _landing(scratch)
    auto = csvsrc.scan_csv(spark, f"{land}/auto", RAW_SCHEMA)
    manual = csvsrc.scan_csv(spark, f"{land}/manual", RAW_SCHEMA)
    assert auto.where(F.col("block") == "007").count() == 1  # leading zeros kept (declared schema)
    source = csvsrc.union_sources(auto, manual).drop("_origin", "dataset_id")
    n_source = source.count()
    store = TableStore(spark, os.path.join(scratch, "store"))
    runner = Runner(spark, store, L.LayerSpec(as_of="2024-01-31", category_k=2))
    res = runner.all_layers(source, n_source)
    assert [r.stage for r in res] == ["raw", "cleaned", "transformed", "hashed"]
    assert all(r.status == ledger.SUCCEEDED for r in res)
    raw = res[0]
    assert raw.by_reason == {L.BLANK_ROW: 1, L.OUTSIDE_RANGE: 1}
    cleaned = res[1]
    assert cleaned.by_reason[L.FIELD_FAILED] == 1 and cleaned.by_reason[L.DUPLICATE_LOWER_PRICE] == 2
    failed = store.read("failed")
    errs = failed.where(F.col("_failure_reason") == L.FIELD_FAILED).select(L.ERRORS).collect()[0][0]
    assert errs.split(", ")[0] == "invalid_storey_range"
    hashed = store.read("hashed")
    assert "resale_identifier" not in hashed.columns and "resale_identifier_hash" in hashed.columns
    assert hashed.where(F.col("town") == "ANG MO KIO").count() >= 1
    # every layer's kept + rejected equals the layer before it
    rep = ledger.reconcile_report(store.read("pipeline_runs"),
                                  ledger.rejects_in_window(failed, store.read("pipeline_runs")).groupBy("run_id")
                                  .agg(F.sum("rejected").alias("rejected")),
                                  ["source", "raw", "cleaned", "transformed", "hashed"])
    assert all(r.reconciled and r.evaluated for r in rep.collect())


def test_gate_blocks_publish(spark, scratch):
    land = _landing(scratch)
    source = csvsrc.scan_csv(spark, f"{land}/auto", RAW_SCHEMA).drop("dataset_id")
    store = TableStore(spark, os.path.join(scratch, "store"))
    runner = Runner(spark, store, L.LayerSpec(as_of="2024-01-31", category_k=2))
    try:
        runner.raw(source, source.count() + 1)  # the source recorded one row more
    except GateError as exc:
        assert "unaccounted" in str(exc)
    else:
        raise AssertionError("gate did not stop the layer")
    assert not store.exists("raw")
    # rows that the rules had rejected keep their reasons, the kept ones are quarantined for the mismatch
    reasons = {r.reason: r.rejected for r in ledger.reject_counts(store.read("failed")).collect()}
    assert sum(reasons.values()) == source.count()
    assert reasons.pop(L.BLANK_ROW) == 1 and reasons.pop(L.OUTSIDE_RANGE) == 1
    ((reason, n),) = reasons.items()
    assert "unaccounted" in reason and n == source.count() - 2
    runs = store.read("pipeline_runs").where(F.col("layer") == "raw").collect()
    assert runs[0].status == ledger.MISMATCH


def test_layer_split_is_exact_on_tx(spark):
    from layerflow.plans import fixtures
    from layerflow.plans.registry import tx_spec
    src = fixtures.tx(spark, "/root/testdata/sf0.001")
    tagged = L.tag_cleaned(src, tx_spec())
    kept = tagged.where(F.col(L.OUTCOME).isNull()).select(fixtures.ROW_ID)
    rej = tagged.where(F.col(L.OUTCOME).isNotNull()).select(fixtures.ROW_ID)
    chk = partition_check(src.select(fixtures.ROW_ID), kept, rej).collect()[0]
    assert chk.missing == 0 and chk.extra == 0 and chk.kept + chk.rejected == chk.input


def test_dedup_independent_of_partitioning(spark):
    li = file_row_id(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"))
    order = ["l_extendedprice", "l_partkey", "l_suppkey"]
    keys = ["l_orderkey", "l_linenumber"]
    a, _ = dedup_keep_max(li, keys, order)
    b, _ = dedup_keep_max(li.repartition(7, "l_partkey"), keys, order)
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())
    assert a.groupBy(*keys).count().where("count > 1").count() == 0


import pytest  # noqa: E402


@pytest.mark.parametrize("partition_by", [None, "month"])
def test_merge_mode_rerun_is_idempotent(spark, scratch, partition_by):
    """Two MERGE runs over the same files leave every layer as one run does."""
    land = _landing(scratch)
    store = TableStore(spark, os.path.join(scratch, "store"))
    counts = []
    for _ in range(2):
        source = csvsrc.scan_csv(spark, f"{land}/auto", RAW_SCHEMA).drop("dataset_id")
        spec = L.LayerSpec(as_of="2024-01-31", category_k=2, partition_by=partition_by)
        runner = Runner(spark, store, spec, load_type="MERGE")
        res = runner.all_layers(source, source.count())
        assert all(r.status == ledger.SUCCEEDED for r in res)
        counts.append({st: store.count(st) for st in ("raw", "cleaned", "transformed", "hashed")})
    assert counts[0] == counts[1]
    assert counts[0]["raw"] == 15  # the copy survives in raw; months are replaced, not merged by key
    assert store.read("hashed").groupBy("surrogate_key").count().where("count > 1").count() == 0


def test_incremental_loop_narrows_window_and_advances_watermark(spark, scratch):
    """MERGE runs read only the lookback window after the first run (K2-K4)."""
    land = _landing(scratch)
    store = TableStore(spark, os.path.join(scratch, "store"))
    params = spark.createDataFrame([(1, "load_type", " merge ", None), (1, "lookback_window", "7", None)],
                                   ledger.LEDGER_SCHEMAS["table_parameters"])
    store.overwrite(params, "table_parameters")
    spec = L.LayerSpec(as_of="2024-01-31", category_k=1, range_start="2012-01-01", range_end="2016-12-31")
    early = [r.replace("2015-03", "2015-02") for r in _good_rows("CLEMENTI", 3, 350000)]  # a month before the second window
    _write(f"{land}/auto/dataset_id=c/x.csv", HEADER, early)
    source = csvsrc.scan_csv(spark, f"{land}/auto", RAW_SCHEMA).drop("dataset_id")
    first = Runner(spark, store, spec)
    assert first.window()[0].isoformat() == "2012-01-01"  # no watermark yet: the whole range
    first.incremental(source)
    mark = first.watermark()
    assert mark == "2015-04-01 00:00:00"
    second = Runner(spark, store, spec)
    lo, _ = second.window()
    assert lo.isoformat() == "2015-03-01"  # the month of watermark - 7 days, from its first day
    # one late row inside the window, one behind it
    _write(f"{land}/auto/dataset_id=d/x.csv", HEADER, [_good_rows("LATE", 1, 360000)[0], early[0].replace("CLEMENTI", "TOO LATE")])
    source = csvsrc.scan_csv(spark, f"{land}/auto", RAW_SCHEMA).drop("dataset_id")
    res = second.incremental(source)
    in_window = source.where("month >= '2015-03'").count()
    assert res[0].kept == in_window  # 2015-02 was not read again
    raw = store.read("raw")
    assert store.count("raw") == raw.count() == first.results[0].kept + 1  # re-read months replace themselves
    assert raw.where("town = 'LATE'").count() == 1 and raw.where("town = 'TOO LATE'").count() == 0
    assert raw.where("month = '2015-02'").count() == 3


def test_scan_csv_groups_folders_by_header(spark, scratch):
    """Folders with one header are read in one scan; a reordered header still binds by name (A1)."""
    root = os.path.join(scratch, "mixed")
    _write(f"{root}/d=1/a.csv", "x,y", ["1,a", "2,b"])
    _write(f"{root}/d=2/b.csv", "x,y", ["3,c"])
    _write(f"{root}/d=3/c.csv", "y,x,z", ["d,4,extra"])
    df = csvsrc.scan_csv(spark, root)
    rows = sorted((int(r["x"]), r["y"], r["z"]) for r in df.select("x", "y", "z").collect())
    assert rows == [(1, "a", None), (2, "b", None), (3, "c", None), (4, "d", "extra")]
    assert csvsrc.scan_csv(spark, os.path.join(scratch, "nothing-here")) is None


def test_scan_csv_binds_mixed_headers_of_one_folder_by_name(spark, scratch):
    root = os.path.join(scratch, "one-folder")
    _write(f"{root}/d=1/a.csv", "town,price", ["BEDOK,10"])
    _write(f"{root}/d=1/b.csv", "price,town", ["20,CLEMENTI"])
    _write(f"{root}/d=1/c.csv", '\ufeff"town","price"', ["TAMPINES,30"])
    open(f"{root}/d=1/empty.csv", "w").close()
    df = csvsrc.scan_csv(spark, root)
    assert sorted((r.town, r.price) for r in df.collect()) == [("BEDOK", "10"), ("CLEMENTI", "20"), ("TAMPINES", "30")]


def test_two_streams_into_one_stage_keep_their_rows(spark, scratch):
    from pyspark.sql import types as T

    from layerflow.streaming.ingest import stream_ingest
    store = TableStore(spark, os.path.join(scratch, "store"))
    schema = T.StructType([T.StructField("x", T.LongType())])
    for name, rows in (("a", ["1", "2", "3"]), ("b", ["4", "5"])):
        _write(f"{scratch}/{name}/f.csv", "x", rows)
        for _ in range(2):  # the second start finds nothing new
            stream_ingest(spark, f"{scratch}/{name}", schema, f"{scratch}/checkpoint-{name}", store, "events").awaitTermination(120)
    assert sorted(r.x for r in store.read("events").collect()) == [1, 2, 3, 4, 5]

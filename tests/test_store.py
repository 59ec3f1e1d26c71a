"""Table store: reload, append, merge, retries, evolution, versions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from layerflow.sources.store import TableStore, merge_frames


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_overwrite_reads_own_table_and_keeps_versions(spark, scratch):
    st = TableStore(spark, scratch)
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    st.overwrite(df, "t")
    stats = st.overwrite(st.read("t").where("id < 4"), "t")  # replaces the rows it reads
    assert (stats.before, stats.after) == (10, 4)
    assert st.read("t").count() == 4
    assert st.read("t", seq=1).count() == 10  # the earlier version is still readable
    st.overwrite(df.where("false"), "t")  # empty batch: old rows stay
    assert st.read("t").count() == 4


def test_append_and_retry_safe_batches(spark, scratch):
    st = TableStore(spark, scratch)
    a, b = spark.range(0, 5), spark.range(5, 8)
    st.append(a, "t", batch_id="a")
    st.append(b, "t", batch_id="b")
    st.append(b, "t", batch_id="b")  # retried batch rewrites itself
    assert _rows(st.read("t"), "id") == [(i,) for i in range(8)]
    assert st.count("t") == 8


def test_merge_updates_inserts_and_keeps_missing_columns(spark, scratch):
    st = TableStore(spark, scratch)
    target = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0)], "k long, name string, price double")
    batch = spark.createDataFrame([(2, 21.0, "x"), (3, 30.0, "y")], "k long, price double, extra string")
    st.merge(target, "t", key="k")
    st.merge(batch, "t", key="k")
    once = _rows(st.read("t"), "k", "name", "price", "extra")
    st.merge(batch, "t", key="k")  # merging twice equals merging once
    assert _rows(st.read("t"), "k", "name", "price", "extra") == once
    assert once == [(1, "a", 10.0, None), (2, "b", 21.0, "x"), (3, None, 30.0, "y")]


def test_merge_requires_unique_batch_key(spark, scratch):
    st = TableStore(spark, scratch)
    st.merge(spark.createDataFrame([(1, 1.0)], "k long, v double"), "t", key="k")
    dup = spark.createDataFrame([(2, 1.0), (2, 2.0)], "k long, v double")
    try:
        st.merge(dup, "t", key="k")
    except RuntimeError:
        return
    raise AssertionError("duplicate batch keys were accepted")


def test_schema_evolution_adds_columns(spark, scratch):
    st = TableStore(spark, scratch)
    st.append(spark.createDataFrame([(1, "a")], "k long, name string"), "t")
    st.append(spark.createDataFrame([(2, "b", 1.5)], "k long, name string, x double"), "t")
    assert _rows(st.read("t"), "k", "x") == [(1, None), (2, 1.5)]


def test_write_by_load_type(spark, scratch):
    st = TableStore(spark, scratch)
    st.write_by_load_type(spark.createDataFrame([(1, 1.0)], "surrogate_key long, v double"), "t", " full ")
    st.write_by_load_type(spark.createDataFrame([(1, 2.0), (2, 3.0)], "surrogate_key long, v double"), "t", "Upsert")
    assert _rows(st.read("t"), "surrogate_key", "v") == [(1, 2.0), (2, 3.0)]
    try:
        st.write_by_load_type(spark.range(1), "t", "sideways")
    except ValueError:
        return
    raise AssertionError("unknown load type accepted")


def test_merge_frames_is_pure(spark):
    t = spark.createDataFrame([(1, 1.0)], "k long, v double")
    b = spark.createDataFrame([(1, 5.0)], "k long, v double")
    assert _rows(merge_frames(t, b, "k"), "k", "v") == [(1, 5.0)]


def test_partitioned_merge_rewrites_only_touched_partitions(spark, scratch):
    st = TableStore(spark, scratch)
    base = spark.createDataFrame([(1, "2015-01", 1.0), (2, "2015-02", 2.0), (3, "2015-03", 3.0)],
                                 "k long, month string, v double")
    st.overwrite_partitioned(base, "t", "month")
    before = st.current("t").segments
    batch = spark.createDataFrame([(2, "2015-02", 20.0), (4, "2015-02", 4.0)], "k long, month string, v double")
    stats = st.merge_partitioned(batch, "t", "k", "month")
    after = st.current("t").segments
    untouched = [s for s in before if not s.endswith("=2015-02")]
    assert all(s in after for s in untouched)  # untouched partitions are not rewritten
    assert stats.after == 4
    assert _rows(st.read("t"), "k", "month", "v") == [(1, "2015-01", 1.0), (2, "2015-02", 20.0),
                                                      (3, "2015-03", 3.0), (4, "2015-02", 4.0)]
    st.replace_partitions(spark.createDataFrame([(9, "2015-03", 9.0)], "k long, month string, v double"), "t", "month")
    assert _rows(st.read("t"), "k") == [(1,), (2,), (4,), (9,)]
    assert st.count("t") == st.read("t").count() == 4  # the recorded total stays exact


def test_rewritten_stage_folder_drops_stale_partitions(spark, scratch):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        st = TableStore(spark, scratch)
        both = spark.createDataFrame([(1, "kept"), (2, "rejected")], "k long, s string")
        p1 = st.stage_write(both, "t", name="run=1", partition_by=["s"])
        p2 = st.stage_write(both.where("s = 'kept'"), "t", name="run=1", partition_by=["s"])
        assert p1 != p2 and st.attempt_base(p1) == st.attempt_base(p2)  # an attempt never touches an earlier one
        assert spark.read.parquet(p1).count() == 2 and spark.read.parquet(p2).count() == 1
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")


def test_orphan_report_lists_unknown_folders(spark, scratch):
    from layerflow.sources.listing import orphans
    st = TableStore(spark, scratch)
    st.overwrite(spark.range(3), "known_table")
    st.overwrite(spark.range(3), "allowed_extra")
    spark.range(2).write.parquet(f"{scratch}/stray_copy")
    known = spark.createDataFrame([("known_table",)], "name string")
    allow = spark.createDataFrame([("allowed_extra",)], "name string")
    assert [r.name for r in orphans(spark, scratch, known, allow).collect()] == ["stray_copy"]


def test_merge_broadcast_batch_equals_full_outer(spark):
    """The small-batch merge (no exchange of the stored rows) gives the full outer join's rows."""
    from layerflow.sources.store import merge_frames

    target = spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (2, "b2", 21), (None, "n", 0), (4, "d", 40)],
        "k int, v string, old_only int")
    batch = spark.createDataFrame(
        [(2, "B", 1.5), (3, "C", 2.5), (3, "C2", 3.5), (None, "N", 0.5), (4, None, None)],
        "k int, v string, new_only double")
    full = merge_frames(target, batch, "k")
    fast = merge_frames(target, batch, "k", broadcast_batch=True)
    assert fast.columns == full.columns == ["k", "v", "old_only", "new_only"]
    assert fast.schema == full.schema
    assert sorted(map(tuple, fast.collect()), key=repr) == sorted(map(tuple, full.collect()), key=repr)
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan


def test_merge_stats_broadcast_equals_full_outer(spark):
    """Merge counts from the broadcast batch equal the full outer join's, duplicates and NULLs included."""
    from layerflow.sources.store import merge_stats

    target = spark.createDataFrame([(1,), (2,), (2,), (None,), (4,)], "k int")
    batch = spark.createDataFrame([(2,), (2,), (3,), (None,), (4,), (5,)], "k int")
    full = merge_stats(target, batch, "k").collect()[0].asDict()
    fast = merge_stats(target, batch, "k", broadcast_batch=True).collect()[0].asDict()
    assert fast == full
    empty = spark.createDataFrame([], "k int")
    assert (merge_stats(empty, batch, "k", broadcast_batch=True).collect()[0].asDict()
            == merge_stats(empty, batch, "k").collect()[0].asDict())


def test_failed_retry_leaves_published_rows(spark, scratch):
    store = TableStore(spark, scratch)
    store.append(spark.range(5), "t", batch_id="b1")
    from pyspark.sql import functions as F
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.append(broken, "t", batch_id="b1")
    assert store.read("t").count() == 5
    store.append(spark.range(7), "t", batch_id="b1")
    assert TableStore(spark, scratch).read("t").count() == store.count("t") == 7


def test_two_writers_lose_nothing(spark, scratch):
    one, two = TableStore(spark, scratch), TableStore(spark, scratch)
    one.append(spark.range(3), "t")
    two.append(spark.range(2), "t")
    one.append(spark.range(4), "t")
    assert one.read("t").count() == two.read("t").count() == TableStore(spark, scratch).count("t") == 9
    assert [v.seq for v in two.versions("t")] == [1, 2, 3]


def test_stale_publish_is_refused(spark, scratch):
    from layerflow.sources.store import ConcurrentWrite
    one, two = TableStore(spark, scratch), TableStore(spark, scratch)
    one.append(spark.range(3), "t")
    base = two.current("t")
    one.append(spark.range(2), "t")
    with pytest.raises(ConcurrentWrite):
        two.publish("t", base.segments, "merge", 3, based_on=base.seq)
    assert two.read("t").count() == 5


def test_replacing_null_and_escaped_partitions(spark, scratch):
    store = TableStore(spark, scratch)
    df = spark.createDataFrame([("x:y", 1), (None, 2), ("z", 3)], "k string, v int")
    store.overwrite_partitioned(df, "t", "k")
    store.replace_partitions(df, "t", "k")
    assert sorted(store.read("t").collect(), key=repr) == sorted(df.collect(), key=repr)

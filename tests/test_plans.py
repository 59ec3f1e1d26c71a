"""Plan checks: no Python UDF, pushed filters, pruned scans, no cartesian product."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerflow.operators import filters
from layerflow.plans import fixtures, layers as L
from layerflow.plans.registry import QUERIES, tx_spec

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_layer_plans_have_no_python_udf(spark):
    src = fixtures.tx(spark, SF)
    chain = L.layer_chain(src, tx_spec())
    for name in ("cleaned", "transformed", "hashed"):
        plan = _plan(chain[name])
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_dedup_does_not_window_over_the_key(spark):
    """Winners come from a partial aggregation, never from a window over a (possibly hot) key."""
    plan = _plan(L.tag_cleaned(fixtures.tx(spark, SF), tx_spec()))
    assert "Window [" not in plan
    assert "max_by" in plan


def test_month_filter_reaches_the_scan(spark, scratch):
    path = f"{scratch}/orders"
    (spark.read.parquet(f"{SF}/orders.parquet")
     .withColumn("month", F.date_format("o_orderdate", "yyyy-MM")).write.parquet(path))
    df = filters.date_range(spark.read.parquet(path), "month", "1996-01-01", "1997-12-31").select("o_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(month), GreaterThanOrEqual(month,1996), LessThan(month,1998)]" in plan
    assert "o_totalprice" not in plan  # only the needed columns are read


def test_no_query_uses_a_cartesian_product(spark):
    for name in ["reject_breakdown_window", "context_nested", "partition_check", "reconcile_report"]:
        plan = _plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_layer_outputs_broadcast_and_never_use_one_partition(spark, scratch):
    """Executed plans of the written layers: broadcast joins, no single-partition exchange."""
    from layerflow.plans.run import Runner
    from layerflow.sources.store import TableStore
    runner = Runner(spark, TableStore(spark, scratch), tx_spec())
    runner.raw(fixtures.tx(spark, SF, row_id=False))
    runner.cleaned()
    plans = {
        "cleaned": L.tag_cleaned(runner.read_layer("raw"), runner.spec, runner._written("cleaned"), check_small=True),
        "transformed": L.tag_transformed(runner.read_layer("cleaned"), runner.spec, runner._written("transformed"),
                                         check_small=True),
    }
    for name, df in plans.items():
        df.write.format("noop").mode("overwrite").save()
        plan = _plan(df)
        assert "BroadcastHashJoin" in plan, name
        assert "SinglePartition" not in plan, name
        assert "Window [" not in plan, name

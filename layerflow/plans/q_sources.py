"""Source, sink, store and filter queries.

Store queries write under a fresh folder of the shared checkpoint folder
and read the result back, so they test the real round trip.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.functions import text
from layerflow.operators import changes, filters
from layerflow.plans import fixtures as X
from layerflow.plans.registry import pipeline_run, register
from layerflow.schema import enforce_schema
from layerflow.session import scratch_path
from layerflow.sources import csv as csvsrc
from layerflow.operators.setops import difference
from layerflow.sources.store import MERGE_BROADCAST_ROWS, TableStore, merge_stats


def _store(spark, what: str) -> TableStore:
    return TableStore(spark, scratch_path(spark, what))


# ---------------------------------------------------------------- CSV

@register("scan_csv", """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT CAST(c_custkey AS BIGINT), c_name, c_mktsegment, NULL FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def q_scan_csv(spark, sf):
    root = scratch_path(spark, "scan_csv")
    c = X.table(spark, sf, "customer")
    # two headers, in two landed folders and in one: a file of the second header comes to the first one's folder
    other = c.where(F.col("c_mktsegment") != "BUILDING").select("c_name", "c_custkey", "c_mktsegment")
    (c.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
     .write.option("header", "true").csv(f"{root}/dataset_id=a"))
    other.where("c_custkey % 2 = 0").write.option("header", "true").csv(f"{root}/dataset_id=b")
    other.where("c_custkey % 2 = 1").write.mode("append").option("header", "true").csv(f"{root}/dataset_id=a")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_mktsegment", T.StringType()), T.StructField("c_acctbal", T.DoubleType())])
    return csvsrc.scan_csv(spark, root, schema).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


def _land_orders(spark, sf) -> str:
    root = scratch_path(spark, "land_csv")
    o = X.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("dataset_id"))
    csvsrc.land_csv(o, root)
    return root


@register("land_csv", """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_totalprice, o_orderpriority AS dataset_id FROM orders""")
def q_land_csv(spark, sf):
    root = _land_orders(spark, sf)
    back = spark.read.option("header", "true").csv(root)  # dataset_id comes back from the folder name
    return back.select(F.col("o_orderkey").cast("bigint"), F.col("o_totalprice").cast("double"),
                       F.col("dataset_id").cast("string"))


@register("landed_counts", """SELECT o_orderpriority AS dataset_id, count(*) AS rows FROM orders GROUP BY 1""")
def q_landed_counts(spark, sf):
    root = _land_orders(spark, sf)
    back = spark.read.option("header", "true").csv(root)
    return csvsrc.landed_counts(back.withColumn("dataset_id", F.col("dataset_id").cast("string")))


@register("union_sources", """
SELECT 'auto' AS _origin, count(*) AS rows FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT 'manual', count(*) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""")
def q_union_sources(spark, sf):
    o = X.table(spark, sf, "orders")
    auto = o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_totalprice")
    manual = o.where(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderstatus")
    return csvsrc.origin_counts(csvsrc.union_sources(auto, manual))


@register("manifest_overlap", """
WITH m AS (SELECT o_orderpriority || '-' || CAST(year(o_orderdate) AS VARCHAR) AS dataset_id,
                  CAST(min(o_orderdate) AS DATE) AS coverage_start, CAST(max(o_orderdate) AS DATE) AS coverage_end
           FROM orders GROUP BY 1)
SELECT dataset_id, coverage_start, coverage_end FROM m
WHERE coverage_start <= DATE '1997-02-28' AND coverage_end >= DATE '1996-03-01'""")
def q_manifest_overlap(spark, sf):
    o = X.table(spark, sf, "orders")
    m = o.groupBy(F.concat_ws("-", "o_orderpriority", F.year("o_orderdate").cast("string")).alias("dataset_id")).agg(
        F.min("o_orderdate").cast("string").alias("coverage_start"),
        F.max("o_orderdate").cast("string").alias("coverage_end"))
    m = csvsrc.manifest_from_iso(m.withColumn("name", F.col("dataset_id")))
    return filters.overlap(m, "1996-03-01", "1997-02-28").select("dataset_id", "coverage_start", "coverage_end")


# ---------------------------------------------------------------- filters

_MONTH_SQL = "strftime(o_orderdate, '%Y-%m')"


@register("date_range_filter", f"""
SELECT o_orderkey FROM orders WHERE {_MONTH_SQL} >= '1996-01' AND {_MONTH_SQL} <= '1997-12'""")
def q_date_range_filter(spark, sf):
    o = X.table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return filters.date_range(o, "month", "1996-01-01", "1997-12-31").select("o_orderkey")


@register("date_range_dropped", f"""
SELECT count(*) FILTER (WHERE {_MONTH_SQL} BETWEEN '1996-01' AND '1997-12') AS kept,
       count(*) FILTER (WHERE NOT ({_MONTH_SQL} BETWEEN '1996-01' AND '1997-12')) AS dropped FROM orders""")
def q_date_range_dropped(spark, sf):
    o = X.table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return filters.date_range_counts(o, "month", "1996-01-01", "1997-12-31")


@register("drop_blank_rows", """
SELECT l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE l.quality IS NOT NULL OR l.toxic IS NOT NULL""")
def q_drop_blank_rows(spark, sf):
    d = X.table(spark, sf, "documents").select("doc_id")
    lab = X.table(spark, sf, "labels")
    return filters.drop_blank(d.join(lab, "doc_id", "left").select("quality", "toxic"))


@register("cap_rows", """
SELECT o_orderkey, o_orderpriority FROM (
  SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders)
WHERE rn <= 5""")
def q_cap_rows(spark, sf):
    o = X.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return filters.cap_rows(o, 5, ["o_orderpriority"], ["o_orderkey"])


@register("sanitize_name", """
SELECT p_partkey, coalesce(nullif(regexp_replace(p_name, '[^\\pL\\pN]', '', 'g'), ''), CAST(p_partkey AS VARCHAR)) AS file_name FROM part""")
def q_sanitize_name(spark, sf):
    p = X.table(spark, sf, "part")
    return p.select("p_partkey", text.sanitize_name("p_name", F.col("p_partkey").cast("string")).alias("file_name"))


# ---------------------------------------------------------------- store round trips

@register("read_layer", """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_read_layer(spark, sf):
    st = _store(spark, "read_layer")
    st.overwrite(X.table(spark, sf, "customer"), "customer")
    return st.read("customer")


@register("append_rows", """SELECT o_orderkey, o_totalprice FROM orders""")
def q_append_rows(spark, sf):
    st = _store(spark, "append_rows")
    o = X.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    st.append(o.where(F.col("o_orderdate") < "1998-01-01"), "orders")
    st.append(o.where(F.col("o_orderdate") >= "1998-01-01"), "orders")
    st.append(o.where(F.lit(False)), "orders")  # empty batch: no-op
    return st.read("orders").select("o_orderkey", "o_totalprice")


@register("full_reload", """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def q_full_reload(spark, sf):
    st = _store(spark, "full_reload")
    o = X.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    st.overwrite(o, "orders")
    st.overwrite(st.read("orders").where(F.col("o_orderdate") >= "1998-01-01"), "orders")  # reads what it replaces
    st.overwrite(o.where(F.lit(False)), "orders")  # empty batch keeps the rows
    return st.read("orders").select("o_orderkey", "o_totalprice")


@register("idempotent_rerun", """SELECT o_orderkey, o_totalprice FROM orders""")
def q_idempotent_rerun(spark, sf):
    st = _store(spark, "idempotent_rerun")
    o = X.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    a, b = o.where(F.col("o_orderdate") < "1998-01-01"), o.where(F.col("o_orderdate") >= "1998-01-01")
    st.append(a, "orders", batch_id="1")
    st.append(b, "orders", batch_id="2")
    st.append(b, "orders", batch_id="2")  # a retried batch replaces itself
    return st.read("orders").select("o_orderkey", "o_totalprice")


_MERGE_SQL = """t AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
b AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')"""


def _merge_inputs(spark, sf):
    o = X.table(spark, sf, "orders")
    target = o.where(F.col("o_orderdate") < "1998-01-01").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    batch = o.where(F.col("o_orderdate") >= "1997-01-01").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderpriority")
    return target, batch


@register("merge_upsert", f"""WITH {_MERGE_SQL}
SELECT b.o_orderkey, t.o_custkey, b.o_totalprice, t.o_orderstatus, b.o_orderpriority FROM b LEFT JOIN t USING (o_orderkey)
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, NULL FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)""")
def q_merge_upsert(spark, sf):
    st = _store(spark, "merge_upsert")
    target, batch = _merge_inputs(spark, sf)
    st.merge(target, "orders", key="o_orderkey")  # first write: plain append
    st.merge(batch, "orders", key="o_orderkey")
    st.merge(batch, "orders", key="o_orderkey")  # merging twice equals merging once
    return st.read("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")


@register("merge_stats", f"""WITH {_MERGE_SQL}
SELECT (SELECT count(*) FROM t) AS rows_before,
       (SELECT count(*) FROM (SELECT o_orderkey FROM t UNION SELECT o_orderkey FROM b)) AS rows_after,
       (SELECT count(*) FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)) AS rows_inserted,
       (SELECT count(*) FROM b WHERE o_orderkey IN (SELECT o_orderkey FROM t)) AS rows_updated""")
def q_merge_stats(spark, sf):
    target, batch = _merge_inputs(spark, sf)
    return merge_stats(target, batch, "o_orderkey", broadcast_batch=batch.count() <= MERGE_BROADCAST_ROWS)


@register("schema_evolution", """
SELECT c_custkey, c_name, NULL::DOUBLE AS c_acctbal FROM customer WHERE c_nationkey < 10
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey >= 10""")
def q_schema_evolution(spark, sf):
    st = _store(spark, "schema_evolution")
    c = X.table(spark, sf, "customer")
    st.append(c.where(F.col("c_nationkey") < 10).select("c_custkey", "c_name"), "customer")
    st.append(c.where(F.col("c_nationkey") >= 10).select("c_custkey", "c_name", "c_acctbal"), "customer")
    return st.read("customer").select("c_custkey", "c_name", "c_acctbal")


@register("enforce_schema", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def q_enforce_schema(spark, sf):
    e = X.table(spark, sf, "events").select("event_id", "user_id", F.get_json_object("props", "$.k").alias("k"))
    return enforce_schema(e, {"event_id": "STRING", "user_id": "STRING", "k": "BIGINT"})


@register("write_by_load_type", """SELECT o_orderkey, o_totalprice FROM orders""")
def q_write_by_load_type(spark, sf):
    st = _store(spark, "write_by_load_type")
    o = X.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    st.write_by_load_type(o.where(F.col("o_orderdate") < "1998-01-01"), "orders", " full ")
    st.write_by_load_type(o, "orders", "upsert", key="o_orderkey")
    return st.read("orders").select("o_orderkey", "o_totalprice")


@register("gate_block", """
WITH tx AS (SELECT 1 FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
            JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN part p ON p.p_partkey = l.l_partkey)
SELECT 'MISMATCH' AS status, CAST(count(*) AS BIGINT) AS quarantined, false AS published FROM tx""")
def q_gate_block(spark, sf):
    """A layer whose counts do not reconcile is quarantined whole and not published."""
    import datetime as dt

    from layerflow.plans import layers as L
    from layerflow.plans.ledger import SUCCEEDED
    from layerflow.plans.run import GateError, Runner
    base = pipeline_run(spark, sf)
    st = _store(spark, "gate_block")
    runner = Runner(spark, st, base.spec)
    # the layer before recorded one row more than really arrived
    runner.record_run("source", SUCCEEDED, base.store.count("raw") + 1, "recorded count off by one",
                      dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    try:
        runner.run_layer("raw", "source", base.store.read("raw").withColumn(L.OUTCOME, F.lit(None).cast("string")))
        status = SUCCEEDED
    except GateError:
        status = "MISMATCH"
    failed = st.read("failed")
    n = 0 if failed is None else failed.count()
    return spark.createDataFrame([(status, n, st.exists("raw"))], "status string, quarantined bigint, published boolean")


# ---------------------------------------------------------------- streaming and listing

@register("stream_ingest", """SELECT CAST(event_id AS BIGINT) AS event_id, event_type, value FROM events""")
def q_stream_ingest(spark, sf):
    from layerflow.streaming.ingest import stream_ingest
    land = scratch_path(spark, "stream_land")
    e = X.table(spark, sf, "events").select("event_id", "event_type", "value")
    e.write.option("header", "true").csv(f"{land}/day=1")
    st = _store(spark, "stream_ingest")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    q = stream_ingest(spark, land, schema, scratch_path(spark, "stream_ckpt"), st, "events")
    q.awaitTermination(600)
    return st.read("events").select("event_id", "event_type", "value")


@register("stream_layers", None)
def q_stream_layers(spark, sf):
    """Landed CSV files streamed in two micro-batches through the whole layer chain (K1).

    The end state must equal the batch pipeline's hashed layer (same oracle).
    """
    from layerflow.plans.registry import tx_spec
    from layerflow.plans.run import Runner
    from layerflow.schema import RAW_SCHEMA
    from layerflow.streaming.ingest import stream_layers
    land = scratch_path(spark, "stream_layers_land")
    src = X.tx(spark, sf, row_id=False).withColumn("dataset_id", F.substring("month", 1, 4))
    csvsrc.land_csv(src, land, compression="gzip")
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(c, T.IntegerType() if t == "int" else T.LongType())
                                             for c, t in X.TX_LINEAGE_TYPES.items()])
    runner = Runner(spark, _store(spark, "stream_layers"), tx_spec(), hashed_publish="FULL")
    # two micro-batches at every size: a landing of more tasks has more files, and each batch judges all landed rows
    half = max(1, -(-csvsrc.list_files(spark, land, "*.csv.gz").count() // 2))
    q = stream_layers(spark, land, schema, scratch_path(spark, "stream_layers_ckpt"), runner,
                      max_files_per_trigger=half)
    q.awaitTermination(3600)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    out = runner.store.read("hashed")
    return out.select(*[c for c in out.columns if not c.startswith("_")])


@register("delta_layers", None)
def q_delta_layers(spark, sf):
    """The streamed chain kept by deltas: all rows but one town's late ones land first, those come in a second run (K1, K3).

    The end state must equal the batch pipeline's hashed layer (same oracle).
    """
    from layerflow.plans.registry import tx_spec
    from layerflow.schema import RAW_SCHEMA
    from layerflow.streaming.delta_layers import DeltaLayers, stream_delta_layers
    root, checkpoint = scratch_path(spark, "delta_layers_land"), scratch_path(spark, "delta_layers_ckpt")
    late = (F.col("town") == "FRANCE") & (F.col("month") >= "1996-01")
    # the view is made once; the late rows' files are copied to the landing folder when their time comes
    src = X.tx(spark, sf, row_id=False).where(late.isNotNull())
    csvsrc.land_csv(src.withColumn("dataset_id", F.when(late, "late").otherwise("base")), root, compression="gzip")
    land, held = f"{root}/dataset_id=base", f"{root}/dataset_id=late"
    for folder in (land, held):  # a part without rows has no folder
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(c, T.IntegerType() if t == "int" else T.LongType())
                                             for c, t in X.TX_LINEAGE_TYPES.items()])
    layers = DeltaLayers(spark, scratch_path(spark, "delta_layers"), tx_spec())
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    for name in ("base", "late"):
        if name == "late":
            spark.read.schema(text).option("header", "true").option("enforceSchema", "false").csv(held).write.option(
                "header", "true").option("compression", "gzip").csv(f"{land}/late")
        q = stream_delta_layers(spark, land, schema, checkpoint, layers)
        q.awaitTermination(3600)
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return layers.layer("hashed")


@register("set_difference", """SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AND c_nationkey <> 0""")
def q_set_difference(spark, sf):
    """Names of customers without a large order, but for those of an allow-listed nation."""
    customers = X.table(spark, sf, "customer")
    name = lambda df, c: df.select(F.col(c).cast("string").alias("name")).distinct()
    return difference(name(customers, "c_custkey"), name(X.table(spark, sf, "orders").where("o_totalprice > 400000"), "o_custkey"),
                      name(customers.where("c_nationkey = 0"), "c_custkey"))


# ---------------------------------------------------------------- change capture: each year's last order of every customer

_LAST_ORDER_SQL = """last AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority,
         arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status
  FROM orders GROUP BY 1, 2),
told AS (
  SELECT *, lag(y) OVER w AS before, lag(priority) OVER w AS p, lag(status) OVER w AS s
  FROM last WINDOW w AS (PARTITION BY o_custkey ORDER BY y)),
classed AS (
  SELECT *, CASE WHEN before IS NULL THEN 'inserted'
                 WHEN p IS DISTINCT FROM priority OR s IS DISTINCT FROM status THEN 'changed' ELSE 'unchanged' END AS change
  FROM told)"""


def _replayed(spark, sf):
    """(year, its batch, the history before it or None), then (None, None, the whole history).

    A batch is the last order of every customer who ordered in the year. Batches and histories are written, as
    they are between runs, so a plan never holds more than one year's join.
    """
    root = scratch_path(spark, "changes")

    def kept(df, name, *by):
        df.write.partitionBy(*by).parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    latest = F.struct("o_orderdate", "o_orderkey")
    last = kept(X.table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(
        F.max_by("o_orderpriority", latest).alias("priority"), F.max_by("o_orderstatus", latest).alias("status")), "last", "y")
    history = None
    for year in [r.y for r in last.select("y").distinct().orderBy("y").collect()]:
        batch = last.filter(F.col("y") == year).drop("y")
        yield year, batch, history
        history = (changes.open_history(batch, F.lit(year)) if history is None
                   else changes.apply_changes(history, batch, _CUSTOMER, _WATCHED, F.lit(year)))
        history = kept(history, f"history-{year}")
    yield None, None, history


_CUSTOMER, _WATCHED = ["o_custkey"], ["priority", "status"]


@register("change_history", f"""WITH {_LAST_ORDER_SQL}
SELECT o_custkey, priority, status, y AS valid_from, CAST(lead(y) OVER (PARTITION BY o_custkey ORDER BY y) AS INTEGER) AS valid_to
FROM classed WHERE change <> 'unchanged'""")
def q_change_history(spark, sf):
    """Every version of a customer's last order, the years' batches applied one after another."""
    return list(_replayed(spark, sf))[-1][2]


@register("change_classes", f"""WITH {_LAST_ORDER_SQL}
SELECT o_custkey, y, change FROM classed""")
def q_change_classes(spark, sf):
    """What each year's batch inserts, changes and leaves as it was."""
    out = None
    for year, batch, history in _replayed(spark, sf):
        if year is None:
            return out
        stored = batch.limit(0) if history is None else history.filter(F.col(changes.TO).isNull())
        found = changes.classify_changes(stored, batch, _CUSTOMER, _WATCHED).select(
            "o_custkey", F.lit(year).alias("y"), F.col(changes.CHANGE).alias("change"))
        out = found if out is None else out.unionByName(found)

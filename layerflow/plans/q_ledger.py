"""Ledger, report and incremental queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from layerflow.functions import text
from layerflow.plans import fixtures as X
from layerflow.plans import ledger as G
from layerflow.plans.registry import RUN_MONTHS, incremental_runs, _CLEAN_CTES, _TRANSFORM_CTES, pipeline_run, register
from layerflow.streaming import incremental as inc

_LEDGER = f"WITH {X.RUNS_SQL}, {X.TABLES_SQL}, {X.PARAMS_SQL}, {X.MARKS_SQL}"


@register("table_parameter", f"""{_LEDGER}
SELECT mt.table_id, coalesce(max(tp.parameter_value), 'NONE') AS parameter_value
FROM (SELECT DISTINCT table_id FROM mt) mt LEFT JOIN tp ON tp.table_id = mt.table_id AND tp.parameter_name = '1-URGENT'
GROUP BY mt.table_id""")
def q_table_parameter(spark, sf):
    return G.parameters_for(X.tables_from_customer(spark, sf), X.params_from_orders(spark, sf), "1-URGENT", "NONE")


@register("watermark_lookup", f"""{_LEDGER}
SELECT mt.table_id, coalesce(max(tw.last_watermark_value), '1900-01-01 00:00:00') AS last_watermark_value
FROM (SELECT DISTINCT table_id FROM mt) mt LEFT JOIN tw ON tw.table_id = mt.table_id GROUP BY mt.table_id""")
def q_watermark_lookup(spark, sf):
    return G.watermark(X.tables_from_customer(spark, sf), X.marks_from_events(spark, sf))


@register("table_id_lookup", f"""{_LEDGER},
names AS (SELECT c_name AS table_name FROM customer UNION ALL SELECT n_name FROM nation)
SELECT names.table_name, CAST(coalesce(ids.id, 1) AS BIGINT) AS table_id
FROM names LEFT JOIN (SELECT table_name, max(table_id) AS id FROM mt GROUP BY 1) ids USING (table_name)""")
def q_table_id_lookup(spark, sf):
    names = (X.table(spark, sf, "customer").select(F.col("c_name").alias("table_name"))
             .unionByName(X.table(spark, sf, "nation").select(F.col("n_name").alias("table_name"))))
    return G.table_id(X.tables_from_customer(spark, sf), names)


@register("context_nested", f"""{_LEDGER},
pm AS (SELECT table_id, string_agg(parameter_name || '=' || v, ';' ORDER BY parameter_name) AS params
       FROM (SELECT table_id, parameter_name, max(parameter_value) AS v FROM tp GROUP BY 1, 2) GROUP BY table_id),
wm AS (SELECT table_id, arg_max(last_watermark_value, last_updated_at) AS watermark FROM tw GROUP BY table_id)
SELECT mt.table_id, mt.table_name, mt.load_order, coalesce(pm.params, '') AS parameters,
       coalesce(wm.watermark, '1900-01-01 00:00:00') AS watermark
FROM mt LEFT JOIN pm USING (table_id) LEFT JOIN wm USING (table_id) WHERE mt.active_flag""")
def q_context_nested(spark, sf):
    ctx = G.context(X.tables_from_customer(spark, sf), X.params_from_orders(spark, sf),
                    X.marks_from_events(spark, sf))
    # The map is flattened to sorted "name=value" text so that it can be compared.
    flat = F.array_join(F.transform(F.array_sort(F.transform(
        F.map_entries("parameters"), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v")))),
        lambda e: F.concat(e["k"], F.lit("="), e["v"])), ";")
    return ctx.select("table_id", "table_name", "load_order", flat.alias("parameters"), "watermark")


@register("active_tables", f"""{_LEDGER}
SELECT table_id, table_name, load_order FROM mt WHERE active_flag""")
def q_active_tables(spark, sf):
    return G.active_tables(X.tables_from_customer(spark, sf)).select("table_id", "table_name", "load_order")


@register("next_run_id", f"""{_LEDGER}
SELECT table_id, CAST(coalesce(max(run_id), 0) + 1 AS BIGINT) AS next_run_id FROM runs GROUP BY table_id""")
def q_next_run_id(spark, sf):
    return G.next_run_id(X.runs_from_events(spark, sf), ["table_id"])


@register("latest_run", f"""{_LEDGER}
SELECT table_id, layer, max(run_id) AS run_id,
       arg_max(status, run_id) AS status, arg_max(number_of_records, run_id) AS number_of_records
FROM runs GROUP BY table_id, layer""")
def q_latest_run(spark, sf):
    return G.latest_run(X.runs_from_events(spark, sf), ["table_id", "layer"]).select(
        "table_id", "layer", "run_id", "status", "number_of_records")


@register("previous_count", f"""{_LEDGER},
ok AS (SELECT table_id, layer, arg_max(number_of_records, run_id) AS n FROM runs
       WHERE status = 'SUCCEEDED' AND number_of_records IS NOT NULL GROUP BY table_id, layer),
chain(layer, previous_layer) AS (VALUES ('raw', 'source'), ('cleaned', 'raw'), ('transformed', 'cleaned'), ('hashed', 'transformed')),
tl AS (SELECT DISTINCT table_id, layer FROM runs)
SELECT tl.table_id, tl.layer, chain.previous_layer, ok.n AS expected_count
FROM tl JOIN chain USING (layer) LEFT JOIN ok ON ok.table_id = tl.table_id AND ok.layer = chain.previous_layer""")
def q_previous_count(spark, sf):
    return G.previous_count(X.runs_from_events(spark, sf))


@register("run_durations", f"""{_LEDGER}
SELECT run_id, round(epoch(end_time) - epoch(start_time), 3) AS duration_seconds FROM runs""")
def q_run_durations(spark, sf):
    r = X.runs_from_events(spark, sf)
    return r.select("run_id", text.duration_seconds("start_time", "end_time").alias("duration_seconds"))


_FAILED_EVENTS_SQL = """fe AS (
  SELECT CASE event_type WHEN 'view' THEN 'source' WHEN 'click' THEN 'raw' WHEN 'signup' THEN 'cleaned'
                         WHEN 'purchase' THEN 'transformed' WHEN 'error' THEN 'hashed' END AS _failed_stage,
         ts AS _failed_at, 'reason_' || CAST(user_id % 3 AS VARCHAR) AS _failure_reason FROM events)"""


def _failed_events(spark, sf):
    e = X.table(spark, sf, "events")
    return e.select(X._layer_of("event_type").alias("_failed_stage"), F.col("ts").alias("_failed_at"),
                    F.concat(F.lit("reason_"), (F.col("user_id") % 3).cast("string")).alias("_failure_reason"))


@register("reject_breakdown_window", f"""{_LEDGER}, {_FAILED_EVENTS_SQL}
SELECT runs.run_id, runs.layer, fe._failure_reason AS reason, count(*) AS rejected
FROM fe JOIN runs ON fe._failed_stage = runs.layer
 AND fe._failed_at BETWEEN runs.start_time - INTERVAL 1 SECOND AND runs.end_time + INTERVAL 1 SECOND
GROUP BY 1, 2, 3""")
def q_reject_breakdown_window(spark, sf):
    return G.rejects_in_window(_failed_events(spark, sf), X.runs_from_events(spark, sf), slack_seconds=1)


_JOBS = {"view": "source", "click": "raw", "signup": "cleaned", "purchase": "transformed"}


@register("sync_runs", """
SELECT CASE event_type WHEN 'view' THEN 'source' WHEN 'click' THEN 'raw' WHEN 'signup' THEN 'cleaned'
                       WHEN 'purchase' THEN 'transformed' END AS layer,
       'SUCCEEDED' AS status, CAST(user_id AS BIGINT) AS number_of_records, ts AS end_time
FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND event_type IN ('view', 'click', 'signup', 'purchase')""")
def q_sync_runs(spark, sf):
    e = X.table(spark, sf, "events")
    audit = e.select(F.col("event_type").alias("job_name"), F.col("user_id").alias("rows_out"),
                     F.col("ts").cast("timestamp").alias("run_timestamp"))
    out = G.sync_runs(audit, "2024-01-15 00:00:00", _JOBS)
    return out.withColumn("end_time", F.col("end_time").cast("timestamp_ntz"))


@register("verify_write", f"""{_LEDGER},
lr AS (SELECT table_id, max(run_id) AS run_id FROM runs GROUP BY table_id)
SELECT lr.table_id, lr.run_id,
       EXISTS (SELECT 1 FROM tw WHERE tw.table_id = lr.table_id AND tw.last_run_id = lr.run_id) AS present
FROM lr""")
def q_verify_write(spark, sf):
    last = X.runs_from_events(spark, sf).groupBy("table_id").agg(F.max("run_id").alias("run_id"))
    marks = X.marks_from_events(spark, sf).select("table_id", F.col("last_run_id").alias("run_id"))
    return G.verify_present(marks, last, ["table_id", "run_id"])


@register("reseed_table", f"""{_LEDGER}
SELECT table_id, parameter_name, parameter_value FROM tp
WHERE table_id NOT IN (SELECT table_id FROM mt WHERE NOT active_flag)
UNION ALL
SELECT table_id, 'load_type', 'FULL' FROM mt WHERE NOT active_flag""")
def q_reseed_table(spark, sf):
    params = X.params_from_orders(spark, sf).select("table_id", "parameter_name", "parameter_value")
    inactive = X.tables_from_customer(spark, sf).where(~F.col("active_flag"))
    rows = inactive.select("table_id", F.lit("load_type").alias("parameter_name"),
                           F.lit("FULL").alias("parameter_value"))
    return G.reseed(params, inactive, rows)


@register("watermark_advance", """
WITH old AS (SELECT CAST(o_custkey AS BIGINT) AS table_id, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_watermark_value,
                    CAST(max(o_orderkey) AS BIGINT) AS last_run_id FROM orders GROUP BY 1),
new AS (SELECT CAST(user_id AS BIGINT) AS table_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_watermark_value,
               CAST(max(event_id) AS BIGINT) AS last_run_id FROM events GROUP BY 1)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE table_id NOT IN (SELECT table_id FROM new)""")
def q_watermark_advance(spark, sf):
    o = X.table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("bigint").alias("table_id")).agg(
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("last_watermark_value"),
        F.max("o_orderkey").cast("bigint").alias("last_run_id"))
    e = X.table(spark, sf, "events").groupBy(F.col("user_id").cast("bigint").alias("table_id")).agg(
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last_watermark_value"),
        F.max("event_id").cast("bigint").alias("last_run_id"))
    return inc.advance_watermark(o, e, "MERGE", True)


def _events_window(spark, sf) -> tuple[dt.date, dt.date]:
    """Watermark = latest event day - 3 days, lookback 7 days (K2)."""
    latest = X.table(spark, sf, "events").agg(F.max("ts").alias("m")).collect()[0]["m"]
    mark = (latest - dt.timedelta(days=3)).strftime("%Y-%m-%d %H:%M:%S")
    return inc.effective_window("MERGE", mark, "2024-01-01", "2024-12-31", lookback_days=7)


_WINDOW_SQL = """w AS (SELECT greatest(DATE '2024-01-01', CAST(max(ts) - INTERVAL 3 DAY AS DATE) - INTERVAL 7 DAY) AS lo FROM events)"""


@register("incremental_window", f"""WITH {_WINDOW_SQL}
SELECT event_id FROM events, w WHERE ts >= w.lo AND ts < DATE '2025-01-01'""")
def q_incremental_window(spark, sf):
    window = _events_window(spark, sf)
    return X.table(spark, sf, "events").where(inc.window_filter("ts", window)).select("event_id")


@register("late_rows_merge", f"""WITH {_WINDOW_SQL},
t AS (SELECT event_id, ts, value FROM events, w WHERE ts < w.lo + INTERVAL 3 DAY),
b AS (SELECT event_id, ts, value + 1 AS value FROM events, w WHERE ts >= w.lo AND ts < DATE '2025-01-01')
SELECT * FROM b UNION ALL SELECT * FROM t WHERE event_id NOT IN (SELECT event_id FROM b)""")
def q_late_rows_merge(spark, sf):
    window = _events_window(spark, sf)
    e = X.table(spark, sf, "events").select("event_id", "ts", "value")
    lo = F.lit(window[0].isoformat()).cast("timestamp_ntz")
    target = e.where(F.col("ts") < lo + F.expr("INTERVAL 3 DAYS"))
    batch = e.withColumn("value", F.col("value") + 1)
    return inc.late_rows_merge(target, batch, "ts", window, "event_id")


@register("clean_error", """
SELECT event_id, coalesce(json_extract_string(props, '$.ErrorMessage'), props) AS error_text FROM events""")
def q_clean_error(spark, sf):
    return X.table(spark, sf, "events").select("event_id", text.clean_error("props").alias("error_text"))


@register("epoch_ms", """
SELECT event_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ms, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_ms FROM events""")
def q_epoch_ms(spark, sf):
    e = X.table(spark, sf, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return e.select("event_id", ms.alias("ms"), text.epoch_ms(ms).cast("timestamp_ntz").alias("ts_ms"))


# ---------------------------------------------------------------- reports over the tx pipeline run

_COUNTS_SQL = f"""{_TRANSFORM_CTES},
cnt AS (SELECT
  (SELECT count(*) FROM tx) AS raw,
  (SELECT count(*) FROM cleaned) AS cleaned,
  (SELECT count(*) FROM transformed) AS transformed,
  (SELECT count(*) FROM transformed WHERE resale_identifier IS NOT NULL AND resale_identifier <> '') AS hashed)"""


@register("count_chain", f"""WITH {_COUNTS_SQL}
SELECT CAST(1 AS BIGINT) AS table_id, raw, cleaned, transformed, hashed,
       round(hashed * 100.0 / raw, 1) AS retained_pct, round((raw - hashed) * 100.0 / raw, 1) AS quarantined_pct FROM cnt""")
def q_count_chain(spark, sf):
    runs = pipeline_run(spark, sf).store.read("pipeline_runs")
    return G.count_chain(runs, ["raw", "cleaned", "transformed", "hashed"])


@register("reconcile_chain", f"""WITH {_COUNTS_SQL},
steps(seq, layer) AS (VALUES (0, 'raw'), (1, 'cleaned'), (2, 'transformed'), (3, 'hashed')),
kk AS (SELECT seq, layer, CASE layer WHEN 'raw' THEN raw WHEN 'cleaned' THEN cleaned WHEN 'transformed' THEN transformed ELSE hashed END AS kept
      FROM steps, cnt),
e AS (SELECT seq, layer, kept, lag(kept) OVER (ORDER BY seq) AS expected_count FROM kk)
SELECT layer, kept, CAST(coalesce(expected_count - kept, 0) AS BIGINT) AS rejected, expected_count,
       'SUCCEEDED' AS status FROM e""")
def q_reconcile_chain(spark, sf):
    run = pipeline_run(spark, sf)
    runs = run.store.read("pipeline_runs")
    kept = G.latest_run(runs, ["table_id", "layer"]).select("table_id", "layer", F.col("number_of_records").alias("kept"))
    rej = (G.reject_counts(run.store.read("failed")).groupBy(F.col("stage").alias("layer"))
           .agg(F.sum("rejected").cast("bigint").alias("rejected")))
    prev = G.previous_count(runs).select("table_id", "layer", "expected_count")
    j = kept.join(prev, ["table_id", "layer"], "left").join(rej, "layer", "left")
    r = F.coalesce(F.col("rejected"), F.lit(0).cast("bigint"))
    return j.select("layer", "kept", r.alias("rejected"), "expected_count",
                    G.reconcile_status(F.col("kept"), r, F.col("expected_count")).alias("status"))


@register("reject_share", f"""WITH {_TRANSFORM_CTES},
cnt AS (
  SELECT 'cleaned' AS stage, 'field_validation_failed' AS reason, count(*) AS rejected FROM v WHERE validation_errors IS NOT NULL
  UNION ALL SELECT 'cleaned', 'duplicate_key_lower_price', count(*) FROM d WHERE rn > 1
  UNION ALL SELECT 'cleaned', 'anomalous_price_iqr_outlier', count(*) FROM o WHERE outlier
  UNION ALL SELECT 'transformed', 'incomplete_resale_identifier', count(*) FROM i WHERE NOT id_valid
  UNION ALL SELECT 'transformed', 'duplicate_key_lower_price', count(*) FROM r WHERE rn > 1),
nz AS (SELECT * FROM cnt WHERE rejected > 0)
SELECT stage, reason, rejected, CAST(sum(rejected) OVER (PARTITION BY stage) AS BIGINT) AS stage_rejected,
       round(rejected * 100.0 / sum(rejected) OVER (PARTITION BY stage), 1) AS share_pct FROM nz""")
def q_reject_share(spark, sf):
    failed = pipeline_run(spark, sf).store.read("failed")
    return G.reject_share(G.reject_counts(failed))


@register("run_tiles", f"""WITH {_COUNTS_SQL}
SELECT CAST(4 AS BIGINT) AS steps_succeeded, CAST(4 AS BIGINT) AS steps_expected, raw AS rows_ingested,
       hashed AS rows_final, CAST(raw - hashed AS BIGINT) AS rows_rejected FROM cnt""")
def q_run_tiles(spark, sf):
    audit = pipeline_run(spark, sf).store.read("audit")
    return G.run_tiles(audit, 4, "raw", "hashed")


@register("run_summary", f"""WITH {_COUNTS_SQL}
SELECT * FROM (VALUES
  ('raw_layer', 'raw', CAST(1 AS BIGINT), (SELECT raw FROM cnt), (SELECT raw FROM cnt), CAST(0 AS BIGINT)),
  ('cleaned_layer', 'cleaned', 1, (SELECT raw FROM cnt), (SELECT cleaned FROM cnt), (SELECT raw - cleaned FROM cnt)),
  ('transformed_layer', 'transformed', 1, (SELECT cleaned FROM cnt), (SELECT transformed FROM cnt), (SELECT cleaned - transformed FROM cnt)),
  ('hashed_layer', 'hashed', 1, (SELECT transformed FROM cnt), (SELECT hashed FROM cnt), (SELECT transformed - hashed FROM cnt))
) AS s(job_name, stage, runs, rows_in, rows_out, quarantined)""")
def q_run_summary(spark, sf):
    run = pipeline_run(spark, sf)
    s = G.run_summary(run.store.read("audit"), G.reject_counts(run.store.read("failed")))
    return s.select("job_name", "stage", "runs", "rows_in", "rows_out", "quarantined")


@register("reconcile_report", f"""WITH {_COUNTS_SQL},
steps(seq, layer) AS (VALUES (1, 'raw'), (2, 'cleaned'), (3, 'transformed'), (4, 'hashed')),
kk AS (SELECT seq, layer, CASE layer WHEN 'raw' THEN raw WHEN 'cleaned' THEN cleaned WHEN 'transformed' THEN transformed ELSE hashed END AS kept
      FROM steps, cnt),
e AS (SELECT seq, layer, kept, lag(kept) OVER (ORDER BY seq) AS expected FROM kk)
SELECT layer, kept, CAST(coalesce(expected - kept, 0) AS BIGINT) AS rejected, expected,
       true AS reconciled, true AS evaluated FROM e""")
def q_reconcile_report(spark, sf):
    run = pipeline_run(spark, sf)
    runs = run.store.read("pipeline_runs")
    failed = run.store.read("failed")
    # rejects per run: quarantine rows of the stage whose time lies in the run's window
    rej = G.rejects_in_window(failed, runs, slack_seconds=1).groupBy("run_id").agg(
        F.sum("rejected").alias("rejected"))
    rep = G.reconcile_report(runs, rej, ["raw", "cleaned", "transformed", "hashed"])
    return rep.select("layer", "kept", "rejected", "expected", "reconciled", "evaluated")


@register("reconcile_incremental", f"""WITH {_COUNTS_SQL},
third AS (SELECT CAST(count(*) AS BIGINT) AS n FROM tx WHERE month >= '{RUN_MONTHS[-1]}')
SELECT 'source' AS layer, n AS kept, CAST(0 AS BIGINT) AS rejected, CAST(NULL AS BIGINT) AS expected, n AS table_total, true AS reconciled FROM third
UNION ALL SELECT 'raw', n, 0, n, raw, true FROM third, cnt
UNION ALL SELECT 'cleaned', cleaned, raw - cleaned, raw, cleaned, true FROM cnt
UNION ALL SELECT 'transformed', transformed, cleaned - transformed, cleaned, transformed, true FROM cnt
UNION ALL SELECT 'hashed', hashed, transformed - hashed, transformed, hashed, true FROM cnt""")
def q_reconcile_incremental(spark, sf):
    """The third of three merged runs reconciles: its own rows against what the layer before handed on."""
    run = incremental_runs(spark, sf)
    runs, failed = run.store.read("pipeline_runs"), run.store.read("failed")
    rej = G.rejects_in_window(failed, runs, slack_seconds=0).groupBy("run_id").agg(F.sum("rejected").alias("rejected"))
    rep = G.reconcile_report(runs, rej, ["source", "raw", "cleaned", "transformed", "hashed"])
    return rep.select("layer", "kept", "rejected", "expected", "table_total", "reconciled")


@register("partition_check", f"""WITH {_CLEAN_CTES}
SELECT CAST((SELECT count(*) FROM tx) AS BIGINT) AS input,
       CAST((SELECT count(*) FROM cleaned) AS BIGINT) AS kept,
       CAST((SELECT count(*) FROM v WHERE validation_errors IS NOT NULL) + (SELECT count(*) FROM d WHERE rn > 1)
            + (SELECT count(*) FROM o WHERE outlier) AS BIGINT) AS rejected,
       CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra""")
def q_partition_check(spark, sf):
    from layerflow.functions.identity import surrogate_key
    from layerflow.operators.setops import partition_check
    run = pipeline_run(spark, sf)
    # Row identity: the key of the raw text (computed before normalising), price, lineage.
    ident = ["surrogate_key", "resale_price", *X.TX_LINEAGE]
    raw = run.store.read("raw").withColumn("surrogate_key", surrogate_key(X.NATURAL_KEY)).select(*ident)
    kept = run.store.read("cleaned").select(*ident)
    failed = run.store.read("failed").where(F.col("_failed_stage") == "cleaned").select(*ident)
    return partition_check(raw, kept, failed)


@register("reconcile_mismatch", f"""{_LEDGER},
ok AS (SELECT table_id, layer, arg_max(number_of_records, run_id) AS n FROM runs
       WHERE status = 'SUCCEEDED' AND number_of_records IS NOT NULL GROUP BY table_id, layer),
last AS (SELECT table_id, layer, arg_max(number_of_records, run_id) AS kept FROM runs GROUP BY table_id, layer),
chain(layer, previous_layer) AS (VALUES ('raw', 'source'), ('cleaned', 'raw'), ('transformed', 'cleaned'), ('hashed', 'transformed')),
j AS (SELECT last.table_id, last.layer, chain.previous_layer, last.kept, CAST(0 AS BIGINT) AS rejected, ok.n AS expected
      FROM last JOIN chain USING (layer) LEFT JOIN ok ON ok.table_id = last.table_id AND ok.layer = chain.previous_layer)
SELECT table_id, layer,
       CASE WHEN expected IS NULL OR kept + rejected = expected THEN 'SUCCEEDED' ELSE 'MISMATCH' END AS status,
       CASE WHEN expected IS NOT NULL THEN expected - (kept + rejected) END AS gap,
       CASE WHEN expected IS NULL THEN layer || ': ' || CAST(kept AS VARCHAR) || ' kept; nothing recorded for ' || previous_layer || ' to compare with'
            WHEN kept + rejected = expected THEN layer || ': ' || CAST(kept AS VARCHAR) || ' kept = ' || CAST(kept AS VARCHAR) || ', equal to ' || previous_layer || ' count ' || CAST(expected AS VARCHAR)
            ELSE layer || ': ' || CAST(kept AS VARCHAR) || ' kept = ' || CAST(kept AS VARCHAR) || ', but ' || previous_layer || ' recorded ' || CAST(expected AS VARCHAR) || '; ' || CAST(expected - kept AS VARCHAR) || ' row(s) unaccounted for' END AS reason
FROM j""")
def q_reconcile_mismatch(spark, sf):
    runs = X.runs_from_events(spark, sf)
    last = G.latest_run(runs, ["table_id", "layer"]).select("table_id", "layer", F.col("number_of_records").alias("kept"))
    prev = G.previous_count(runs)
    j = last.join(prev, ["table_id", "layer"]).withColumn("rejected", F.lit(0).cast("bigint"))
    k, r, e = F.col("kept"), F.col("rejected"), F.col("expected_count")
    return j.select("table_id", "layer", G.reconcile_status(k, r, e).alias("status"),
                    G.reconcile_gap(k, r, e).alias("gap"),
                    G.reconcile_reason(F.col("layer"), F.col("previous_layer"), k, r, e).alias("reason"))


@register("reject_breakdown", f"""WITH {_TRANSFORM_CTES},
cnt AS (
  SELECT 'cleaned' AS stage, 'field_validation_failed' AS reason, count(*) AS rejected FROM v WHERE validation_errors IS NOT NULL
  UNION ALL SELECT 'cleaned', 'duplicate_key_lower_price', count(*) FROM d WHERE rn > 1
  UNION ALL SELECT 'cleaned', 'anomalous_price_iqr_outlier', count(*) FROM o WHERE outlier
  UNION ALL SELECT 'transformed', 'incomplete_resale_identifier', count(*) FROM i WHERE NOT id_valid
  UNION ALL SELECT 'transformed', 'duplicate_key_lower_price', count(*) FROM r WHERE rn > 1)
SELECT stage, reason, rejected FROM cnt WHERE rejected > 0 ORDER BY rejected DESC""")
def q_reject_breakdown(spark, sf):
    """Rejects per (stage, reason) since the run began, largest first."""
    run = pipeline_run(spark, sf)
    failed = run.store.read("failed")
    since = failed.agg(F.min("_failed_at")).collect()[0][0]
    recent = failed.where(F.col("_failed_at") >= F.lit(since))
    return G.reject_counts(recent).orderBy(F.desc("rejected"), "stage", "reason")


_SPLIT = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]


def _split_lines(spark, sf):
    """Line items; those not returned as kept and returned ones as rejected, but lines of a quantity of 1 in neither."""
    lines = X.table(spark, sf, "lineitem").select(*_SPLIT)
    here = lines.where("l_quantity > 1")
    return lines, here.where("l_returnflag <> 'R'"), here.where("l_returnflag = 'R'")


@register("fingerprint_check", """
SELECT 'whole' AS what, count(*) AS input, count(*) FILTER (l_returnflag <> 'R') AS kept,
       count(*) FILTER (l_returnflag = 'R') AS rejected, true AS balanced FROM lineitem
UNION ALL
SELECT 'lossy', count(*), count(*) FILTER (l_returnflag <> 'R' AND l_quantity > 1),
       count(*) FILTER (l_returnflag = 'R' AND l_quantity > 1), count(*) FILTER (l_quantity <= 1) = 0 FROM lineitem""")
def q_fingerprint_check(spark, sf):
    from layerflow.operators.setops import fingerprint_check
    lines, kept, rejected = _split_lines(spark, sf)
    whole = fingerprint_check(lines, lines.where("l_returnflag <> 'R'"), lines.where("l_returnflag = 'R'"))
    lossy = fingerprint_check(lines, kept, rejected)
    out = [df.select(F.lit(name).alias("what"), "*") for name, df in (("whole", whole), ("lossy", lossy))]
    return out[0].unionByName(out[1])


@register("unbalanced_rows", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, count(*) AS missing, CAST(0 AS BIGINT) AS extra
FROM lineitem WHERE l_quantity <= 1 GROUP BY ALL""")
def q_unbalanced_rows(spark, sf):
    from layerflow.operators.setops import unbalanced_rows
    return unbalanced_rows(*_split_lines(spark, sf))


@register("missing_parameters", """
SELECT c_custkey AS table_id, n AS parameter_name
FROM (SELECT CAST(c_custkey AS BIGINT) AS c_custkey FROM customer), (VALUES ('1-URGENT'), ('5-LOW')) v(n)
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = n)""")
def q_missing_parameters(spark, sf):
    """Customers as tables, their orders as parameters: which lack one of two priorities."""
    tables = X.table(spark, sf, "customer").select(F.col("c_custkey").cast("bigint").alias("table_id"))
    params = X.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("bigint").alias("table_id"), F.col("o_orderpriority").alias("parameter_name"),
        F.col("o_totalprice").cast("string").alias("parameter_value"))
    return G.missing_parameters(tables, params, ["1-URGENT", "5-LOW"])


_EVENT_JOBS = {**_JOBS, "refund_check": "hashed"}
_EVENT_AUDIT_SQL = """a AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS job_name, CAST(user_id % 5 AS BIGINT) AS rows_out, CAST(user_id % 3 AS BIGINT) AS rows_rejected,
         ts AS run_timestamp, CAST(user_id % 7 AS DOUBLE) / 4 AS duration_seconds FROM events)"""


def _event_audit(spark, sf):
    """Events as audit rows: types are jobs, users give counts and durations (a fifth of the runs kept no rows)."""
    u = F.col("user_id")
    return X.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"), F.col("event_type").alias("job_name"), (u % 5).cast("bigint").alias("rows_out"),
        (u % 3).cast("bigint").alias("rows_rejected"), F.col("ts").cast("timestamp").alias("run_timestamp"), ((u % 7).cast("double") / 4).alias("duration_seconds"))


@register("ledger_rows", f"""WITH {_EVENT_AUDIT_SQL}
SELECT CAST('0x' || substr(sha256(run_id), 1, 15) AS BIGINT) AS run_id, CAST(7 AS BIGINT) AS table_id,
       CASE job_name WHEN 'view' THEN 'source' WHEN 'click' THEN 'raw' WHEN 'signup' THEN 'cleaned' WHEN 'purchase' THEN 'transformed' END AS layer,
       run_timestamp - to_microseconds(CAST(round(duration_seconds * 1000000) AS BIGINT)) AS start_time, run_timestamp AS end_time,
       CASE WHEN rows_out = 0 THEN 'EMPTY' ELSE 'SUCCEEDED' END AS status, rows_out AS number_of_records,
       CASE WHEN rows_out = 0 THEN job_name || ' kept no rows' END AS error_message
FROM a WHERE run_timestamp >= TIMESTAMP '2024-01-15 00:00:00' AND job_name IN ('view', 'click', 'signup', 'purchase')
  AND NOT (run_timestamp >= TIMESTAMP '2024-01-20 00:00:00' AND job_name = 'click')""")
def q_ledger_rows(spark, sf):
    """Audit rows since a time as ledger rows; the clicks of the last days are in the ledger already."""
    audit = _event_audit(spark, sf)
    synced = G.ledger_rows(audit, "2024-01-20 00:00:00", {"click": "raw"}, 7)
    out = G.ledger_rows(audit, "2024-01-15 00:00:00", _EVENT_JOBS, 7, synced)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})


_STATUS_SQL = f"""{_EVENT_AUDIT_SQL},
jobs(job_name, stage) AS (VALUES ('view', 'source'), ('click', 'raw'), ('signup', 'cleaned'), ('purchase', 'transformed'), ('refund_check', 'hashed')),
g AS (SELECT job_name, count(*) AS runs, sum(rows_out) AS records, sum(rows_rejected) AS rejected, sum(duration_seconds) AS seconds,
             max({{'t': run_timestamp, 'n': rows_out}}).n AS last_out
      FROM a WHERE run_timestamp >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY job_name),
st AS (SELECT job_name, stage, CASE WHEN runs IS NULL THEN 'NOT_RUN' WHEN coalesce(last_out, 0) = 0 THEN 'EMPTY' ELSE 'SUCCEEDED' END AS status,
              coalesce(runs, 0) AS runs, CAST(coalesce(records, 0) AS BIGINT) AS records, CAST(coalesce(rejected, 0) AS BIGINT) AS rejected,
              round(coalesce(seconds, 0), 3) AS seconds FROM jobs LEFT JOIN g USING (job_name))"""


@register("job_status", f"WITH {_STATUS_SQL} SELECT * FROM st")
def q_job_status(spark, sf):
    return G.job_status(_event_audit(spark, sf), _EVENT_JOBS, "2024-01-15 00:00:00")


@register("run_totals", f"""WITH {_STATUS_SQL}
SELECT count(*) AS jobs, count(*) FILTER (status = 'SUCCEEDED') AS succeeded, count(*) FILTER (status = 'NOT_RUN') AS not_run,
       CAST(sum(runs) AS BIGINT) AS runs, CAST(sum(rejected) AS BIGINT) AS rejected, round(sum(seconds), 3) AS seconds FROM st""")
def q_run_totals(spark, sf):
    return G.run_totals(G.job_status(_event_audit(spark, sf), _EVENT_JOBS, "2024-01-15 00:00:00"))


@register("rejects_since", f"""WITH {_FAILED_EVENTS_SQL}
SELECT _failed_stage AS stage, _failure_reason AS reason, count(*) AS rejected
FROM fe WHERE _failed_at >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2""")
def q_rejects_since(spark, sf):
    return G.reject_counts(_failed_events(spark, sf), since="2024-01-15 00:00:00")


@register("audit_rows", f"""WITH {_COUNTS_SQL}
SELECT * FROM (VALUES
  ('raw_layer', 'raw', (SELECT raw FROM cnt), (SELECT raw FROM cnt)), ('cleaned_layer', 'cleaned', (SELECT raw FROM cnt), (SELECT cleaned FROM cnt)),
  ('transformed_layer', 'transformed', (SELECT cleaned FROM cnt), (SELECT transformed FROM cnt)),
  ('hashed_layer', 'hashed', (SELECT transformed FROM cnt), (SELECT hashed FROM cnt))) AS s(job_name, stage, rows_in, rows_out)""")
def q_audit_rows(spark, sf):
    """What each layer's write observed, as the audit recorded it."""
    return pipeline_run(spark, sf).store.read("audit").select("job_name", "stage", "rows_in", "rows_out")


@register("write_metrics", """
SELECT flag, CAST(n AS BIGINT) AS rows FROM (
  SELECT 'rows' AS flag, count(*) AS n FROM lineitem UNION ALL SELECT l_returnflag, count(*) FROM lineitem GROUP BY 1)""")
def q_write_metrics(spark, sf):
    """Line items written once, by flag; the counts are those that the write observed."""
    import uuid

    from layerflow.operators.observed import per_value, write_observed
    from layerflow.session import scratch_path
    lines = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    seen = write_observed(lines, f"{scratch_path(spark, 'observed')}/{uuid.uuid4().hex}", ["l_returnflag"], per_value("l_returnflag", ["A", "N", "R"]))
    return spark.createDataFrame(list(seen.items()), "flag string, rows bigint")

"""Run ledger, reconciliation and reports over tables-as-data.

Ledger tables are ordinary DataFrames:

* ``metadata_tables``  (table_id, table_name, ..., active_flag, load_order)
* ``table_parameters`` (table_id, parameter_name, parameter_value)
* ``table_watermarks`` (table_id, last_watermark_value, last_updated_at, last_run_id)
* ``pipeline_runs``    (run_id, table_id, layer, start_time, end_time, status,
  number_of_records, error_message)
* ``audit``            (run_id, job_name, stage, rows_in, rows_out, rows_rejected,
  run_timestamp, duration_seconds)

Every function here is a DataFrame transformation (a grouped aggregate, a
window per small key, or an equi-join); the few driver-side helpers only
read one small aggregated row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.functions.text import int_or_zero
from layerflow.operators.groups import BROADCAST_MAX_ROWS

# Run statuses, the layer order of the chain and the job of each layer.
SUCCEEDED = "SUCCEEDED"
MISMATCH = "MISMATCH"
FAILED = "FAILED"
EMPTY = "EMPTY"
NOT_RUN = "NOT_RUN"
DEFAULT_WATERMARK = "1900-01-01 00:00:00"
LAYER_ORDER = ["source", "raw", "profiling", "cleaned", "transformed", "hashed"]
REPORT_ONLY = {"profiling"}
LAYER_JOBS = {
    "source": "ingestion_to_source",
    "raw": "raw_layer",
    "profiling": "data_profiling",
    "cleaned": "cleaned_layer",
    "transformed": "transformed_layer",
    "hashed": "hashed_layer",
}

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("table_id", T.LongType()),
    T.StructField("layer", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("number_of_records", T.LongType()),
    T.StructField("error_message", T.StringType()),
])
# What the runner stores: also the rows that the run kept, as number_of_records is the layer's total where runs add up.
RUNS_STORED = T.StructType([*RUNS_SCHEMA.fields, T.StructField("rows_kept", T.LongType())])

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("job_name", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("rows_in", T.LongType()),
    T.StructField("rows_out", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("run_timestamp", T.TimestampType()),
    T.StructField("duration_seconds", T.DoubleType()),
])


LEDGER_SCHEMAS = {
    "metadata_tables": T.StructType([
        T.StructField("table_id", T.LongType()), T.StructField("table_name", T.StringType()),
        T.StructField("source_system", T.StringType()), T.StructField("source_schema", T.StringType()),
        T.StructField("source_table", T.StringType()), T.StructField("source_path", T.StringType()),
        T.StructField("target_layer", T.StringType()), T.StructField("bronze_schema", T.StringType()),
        T.StructField("silver_schema", T.StringType()), T.StructField("gold_schema", T.StringType()),
        T.StructField("active_flag", T.BooleanType()), T.StructField("load_order", T.LongType()),
        T.StructField("created_at", T.TimestampType())]),
    "table_parameters": T.StructType([
        T.StructField("table_id", T.LongType()), T.StructField("parameter_name", T.StringType()),
        T.StructField("parameter_value", T.StringType()), T.StructField("created_at", T.TimestampType())]),
    "table_watermarks": T.StructType([
        T.StructField("table_id", T.LongType()), T.StructField("last_watermark_value", T.StringType()),
        T.StructField("last_updated_at", T.TimestampType()), T.StructField("last_run_id", T.LongType())]),
    "pipeline_runs": RUNS_SCHEMA,
}


def read_ledger(store) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """All ledger tables; a table that cannot be read gives an empty frame and an error entry."""
    frames, errors = {}, {}
    for name, schema in LEDGER_SCHEMAS.items():
        try:
            df = store.read(name)
        except Exception as exc:  # noqa: BLE001 - collected, not raised
            df, errors[name] = None, str(exc)
        frames[name] = df if df is not None else store.spark.createDataFrame([], schema)
    return frames, errors


# ---------------------------------------------------------------- lookups

def parameter(params: DataFrame, table_id: Column | int, name: str, default: str | None = None) -> DataFrame:
    """Value of one parameter per table, with a default (A4). Output: table_id, parameter_value."""
    hit = params.where(F.col("parameter_name") == name)
    if not isinstance(table_id, Column):
        hit = hit.where(F.col("table_id") == table_id)
    agg = hit.groupBy("table_id").agg(F.max("parameter_value").alias("parameter_value"))
    if default is not None:
        agg = agg.withColumn("parameter_value", F.coalesce("parameter_value", F.lit(default)))
    return agg


def parameters_for(tables: DataFrame, params: DataFrame, name: str, default: str | None) -> DataFrame:
    """Every table's value of one parameter; tables without it get the default (A4)."""
    p = (params.where(F.col("parameter_name") == name)
         .groupBy("table_id").agg(F.max("parameter_value").alias("_v")))
    return (tables.select("table_id").distinct().join(p, "table_id", "left")
            .select("table_id", F.coalesce("_v", F.lit(default)).alias("parameter_value")))


def missing_parameters(tables: DataFrame, params: DataFrame, names: list[str]) -> DataFrame:
    """table_id and parameter_name of every required parameter that a table lacks or has as NULL (A4)."""
    asked = tables.select("table_id").distinct().withColumn("parameter_name", F.explode(F.array(*[F.lit(n) for n in names])))
    there = params.where(F.col("parameter_name").isin(names) & F.col("parameter_value").isNotNull())
    return asked.join(there.select("table_id", "parameter_name"), ["table_id", "parameter_name"], "left_anti")


def require_parameters(tables: DataFrame, params: DataFrame, names: list[str], shown: int = 10) -> None:
    """Raise if a table lacks a required parameter, naming the first few (A4)."""
    lacking = missing_parameters(tables, params, names).orderBy("table_id", "parameter_name").limit(shown).collect()
    if lacking:
        raise ValueError("required parameters are missing: " + ", ".join(f"{r.parameter_name} of table {r.table_id}" for r in lacking))


def watermark(tables: DataFrame, marks: DataFrame, default: str = DEFAULT_WATERMARK) -> DataFrame:
    """Watermark per table; absent or NULL gives the default (A5)."""
    w = marks.groupBy("table_id").agg(F.max("last_watermark_value").alias("_w"))
    return (tables.select("table_id").distinct().join(w, "table_id", "left")
            .select("table_id", F.coalesce("_w", F.lit(default)).alias("last_watermark_value")))


def table_id(tables: DataFrame, names: DataFrame, default: int = 1) -> DataFrame:
    """Resolve table ids by name; unknown names get ``default`` (A8). ``names`` has ``table_name``."""
    ids = tables.groupBy("table_name").agg(F.max("table_id").alias("_id"))
    return (names.join(ids, "table_name", "left")
            .select("table_name", F.coalesce("_id", F.lit(default)).cast("bigint").alias("table_id")))


def active_tables(tables: DataFrame) -> DataFrame:
    """Active tables in load order."""
    return tables.where(F.col("active_flag")).orderBy("load_order", "table_id")


def context(tables: DataFrame, params: DataFrame, marks: DataFrame,
            default_watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """One nested row per active table: its parameters as a map and its watermark."""
    one = params.groupBy("table_id", "parameter_name").agg(F.max("parameter_value").alias("parameter_value"))
    pmap = (one.groupBy("table_id")
            .agg(F.map_from_entries(F.array_sort(F.collect_list(
                F.struct("parameter_name", "parameter_value")))).alias("parameters")))
    w = marks.groupBy("table_id").agg(F.max_by(F.struct("last_watermark_value", "last_run_id"),
                                                F.col("last_updated_at")).alias("_w"))
    t = tables.where(F.col("active_flag"))
    return (t.join(pmap, "table_id", "left").join(w, "table_id", "left")
            .select("table_id", "table_name", "load_order",
                    F.coalesce("parameters", F.create_map().cast("map<string,string>")).alias("parameters"),
                    F.coalesce(F.col("_w.last_watermark_value"), F.lit(default_watermark)).alias("watermark"),
                    F.col("_w.last_run_id").alias("watermark_run_id")))


# ---------------------------------------------------------------- runs

def next_run_id(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """max(run_id) + 1, 1 when there is none (F16); per group when ``by`` is given."""
    nxt = (F.coalesce(F.max("run_id"), F.lit(0)) + 1).cast("bigint").alias("next_run_id")
    return runs.groupBy(*by).agg(nxt) if by else runs.agg(nxt)


def latest_run(runs: DataFrame, by: list[str], status: str | None = None) -> DataFrame:
    """The run with the highest run_id per group.

    Groups are few (table x layer), so the ``max_by`` aggregate is cheap and
    never sorts a whole group.
    """
    r = runs if status is None else runs.where(F.col("status") == status)
    cols = [c for c in r.columns if c not in by]
    best = F.max_by(F.struct(*cols), F.struct("run_id"))
    return r.groupBy(*by).agg(best.alias("_r")).select(*by, "_r.*")


def previous_count(runs: DataFrame, table: int | None = None) -> DataFrame:
    """Each layer with the latest successful count of the layer before it (E5).

    Output: table_id, layer, previous_layer, expected_count.
    """
    order = _layer_order(runs.sparkSession)
    ok = latest_run(runs.where(F.col("number_of_records").isNotNull()), ["table_id", "layer"], SUCCEEDED)
    if table is not None:
        ok = ok.where(F.col("table_id") == table)
    prev = order.select(F.col("layer").alias("previous_layer"), (F.col("seq") + 1).alias("_next"))
    chain = order.join(prev, order.seq == prev._next).select("layer", "previous_layer")
    tables_layers = runs.select("table_id", "layer").distinct().join(F.broadcast(chain), "layer")
    return (tables_layers.join(ok.select("table_id", F.col("layer").alias("previous_layer"),
                                         F.col("number_of_records").alias("expected_count")),
                               ["table_id", "previous_layer"], "left")
            .select("table_id", "layer", "previous_layer", "expected_count"))


def _layer_order(spark) -> DataFrame:
    """(seq, layer) of the reconciled layers: a fixed lookup of a few rows."""
    chain = [n for n in LAYER_ORDER if n not in REPORT_ONLY]
    return spark.createDataFrame(list(enumerate(chain)), "seq int, layer string")


def reconcile(kept: int, rejected: int, expected: int | None, layer: str, previous: str) -> tuple[str, str]:
    """Gate decision and reason text (J1, L16) for one layer run."""
    total = kept + rejected
    shown = f"{kept} kept" + (f" + {rejected} rejected" if rejected else "")
    if expected is None:
        return SUCCEEDED, f"{layer}: {shown}; nothing recorded for {previous} to compare with"
    if total == expected:
        return SUCCEEDED, f"{layer}: {shown} = {total}, equal to {previous} count {expected}"
    return MISMATCH, (f"{layer}: {shown} = {total}, but {previous} recorded {expected}; "
                      f"{expected - total} row(s) unaccounted for")


def reconcile_reason(layer: Column, previous: Column, kept: Column, rejected: Column,
                     expected: Column) -> Column:
    """Column form of the reason text."""
    total = kept + rejected
    shown = F.concat(kept.cast("string"), F.lit(" kept"),
                     F.when(rejected != 0, F.concat(F.lit(" + "), rejected.cast("string"), F.lit(" rejected")))
                     .otherwise(F.lit("")))
    return (F.when(expected.isNull(), F.concat(layer, F.lit(": "), shown, F.lit("; nothing recorded for "),
                                               previous, F.lit(" to compare with")))
            .when(total == expected, F.concat(layer, F.lit(": "), shown, F.lit(" = "), total.cast("string"),
                                              F.lit(", equal to "), previous, F.lit(" count "), expected.cast("string")))
            .otherwise(F.concat(layer, F.lit(": "), shown, F.lit(" = "), total.cast("string"), F.lit(", but "),
                                previous, F.lit(" recorded "), expected.cast("string"), F.lit("; "),
                                (expected - total).cast("string"), F.lit(" row(s) unaccounted for"))))


def reconcile_status(kept: Column, rejected: Column, expected: Column) -> Column:
    """Column form of the gate decision."""
    return (F.when(expected.isNull(), F.lit(SUCCEEDED))
            .when(kept + rejected == expected, F.lit(SUCCEEDED))
            .otherwise(F.lit(MISMATCH)))


def reconcile_gap(kept: Column, rejected: Column, expected: Column) -> Column:
    return F.when(expected.isNotNull(), expected - (kept + rejected))


# ---------------------------------------------------------------- rejects

def reject_counts(failed: DataFrame, stage_col: str = "_failed_stage",
                  reason_col: str = "_failure_reason", since: str | None = None, time_col: str = "_failed_at") -> DataFrame:
    """Rejected rows per (stage, reason) (F12), with ``since`` those rejected from that time on."""
    if since is not None:
        failed = failed.where(F.col(time_col) >= F.lit(since).cast("timestamp"))
    return failed.groupBy(F.col(stage_col).alias("stage"), F.col(reason_col).alias("reason")).agg(
        F.count(F.lit(1)).cast("bigint").alias("rejected"))


def reject_share(counts: DataFrame) -> DataFrame:
    """Each reason's share of its stage's rejects in %, 1 decimal."""
    w = Window.partitionBy("stage")
    total = F.sum("rejected").over(w)
    return counts.select("stage", "reason", "rejected", total.cast("bigint").alias("stage_rejected"),
                         F.round(F.col("rejected") * 100.0 / total, 1).alias("share_pct"))


def rejects_in_window(failed: DataFrame, runs: DataFrame, slack_seconds: int = 1,
                      time_col: str = "_failed_at", bucket_seconds: int = 300,
                      max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Rejects whose time falls in a run's window widened by ``slack``.

    A range join done as an equi-join: time is cut into buckets of
    ``bucket_seconds``; a run window is listed under every bucket it
    touches (a few, as runs are short), a reject under its one bucket.
    The join is on (stage, bucket) and the exact range test runs on the
    matched pairs only, so no stage is compared all-against-all.
    All rejects of one run share a time, hence one hot (stage, bucket) key.
    The run side is counted: up to ``max_rows`` rows it is broadcast and the
    rejects are never shuffled; above, the rejects are first counted per
    (stage, time, reason) — copies collapse on the map side — and only those
    counts are shuffled into the sort-merge join.
    Output: run_id, layer, reason, rejected.
    """
    lo = F.unix_micros(F.col("start_time").cast("timestamp")) - slack_seconds * 1_000_000
    hi = F.unix_micros(F.col("end_time").cast("timestamp")) + slack_seconds * 1_000_000
    b = F.lit(bucket_seconds * 1_000_000)
    r = runs.select("run_id", F.col("layer").alias("_layer"), lo.alias("_lo"), hi.alias("_hi"),
                    F.explode(F.sequence(F.floor(lo / b), F.floor(hi / b))).alias("_bucket"))
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    f = failed.select(F.col("_failed_stage").alias("_layer"), t.alias("_t"),
                      F.col("_failure_reason").alias("reason"), F.floor(t / b).alias("_bucket"))
    keys = ["_layer", "_bucket"]
    if r.count() <= max_rows:
        j = f.withColumn("_n", F.lit(1)).join(F.broadcast(r), keys, "inner")
    else:
        pre = f.groupBy("_layer", "_t", "reason", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        j = pre.join(r, keys, "inner")
    j = j.where(F.col("_t").between(F.col("_lo"), F.col("_hi")))
    return (j.groupBy("run_id", F.col("_layer").alias("layer"), "reason")
            .agg(F.sum("_n").cast("bigint").alias("rejected")))


def rejects_in_window_naive(failed: DataFrame, runs: DataFrame, slack_seconds: int = 1,
                            time_col: str = "_failed_at") -> DataFrame:
    """Reference form of E6 for small tests: equi-join on stage, then the range."""
    r = runs.select("run_id", F.col("layer").alias("_layer"),
                    (F.col("start_time") - F.expr(f"INTERVAL {slack_seconds} SECONDS")).alias("_lo"),
                    (F.col("end_time") + F.expr(f"INTERVAL {slack_seconds} SECONDS")).alias("_hi"))
    f = failed.select(F.col("_failed_stage").alias("_layer"), F.col(time_col).alias("_t"),
                      F.col("_failure_reason").alias("reason"))
    j = f.join(r, "_layer").where(F.col("_t").between(F.col("_lo"), F.col("_hi")))
    return (j.groupBy("run_id", F.col("_layer").alias("layer"), "reason")
            .agg(F.count(F.lit(1)).cast("bigint").alias("rejected")))


def map_names(df: DataFrame, col: str, mapping: dict[str, str], out: str) -> DataFrame:
    """Stage tag -> job name through a small lookup table."""
    lookup = df.sparkSession.createDataFrame(list(mapping.items()), f"{col} string, {out} string")
    return df.join(F.broadcast(lookup), col, "left")


def verify_present(df: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows with a flag: present in ``df`` (semi-join) or not."""
    hit = df.select(*keys).distinct().withColumn("present", F.lit(True))
    return (expected.join(hit, keys, "left")
            .withColumn("present", F.coalesce("present", F.lit(False))))


def reseed(df: DataFrame, table_ids: DataFrame, rows: DataFrame) -> DataFrame:
    """Replace all rows of the given tables with new rows (J6): anti-join + union."""
    return df.join(table_ids.select("table_id").distinct(), "table_id", "left_anti").unionByName(
        rows.select(*df.columns))


def sync_runs(audit: DataFrame, since: str, jobs: dict[str, str]) -> DataFrame:
    """Ledger rows from audit rows since a time, for known jobs only."""
    known = map_names(audit.where(F.col("run_timestamp") >= F.lit(since).cast("timestamp")),
                      "job_name", jobs, "layer").where(F.col("layer").isNotNull())
    return known.select("layer", F.lit(SUCCEEDED).alias("status"),
                        F.col("rows_out").cast("bigint").alias("number_of_records"),
                        F.col("run_timestamp").alias("end_time"))


def ledger_rows(audit: DataFrame, since: str, jobs: dict[str, str], table_id: int, runs: DataFrame | None = None) -> DataFrame:
    """Whole rows of the run ledger from audit rows since a time, for known jobs only.

    The run id is the first 60 bits of the SHA-256 of the audit row's id, so syncing again finds the same ids;
    those that ``runs`` has already are left out. A run began ``duration_seconds`` before its audit row. A run that
    kept nothing is EMPTY and says so in ``error_message``, which is null otherwise.
    """
    known = map_names(audit.where(F.col("run_timestamp") >= F.lit(since).cast("timestamp")), "job_name", jobs, "layer").where(F.col("layer").isNotNull())
    none = F.coalesce(F.col("rows_out"), F.lit(0)) == 0
    began = F.timestamp_micros(F.unix_micros("run_timestamp") - F.round(F.coalesce("duration_seconds", F.lit(0.0)) * 1e6).cast("bigint"))
    rows = known.select(
        F.conv(F.substring(F.sha2("run_id", 256), 1, 15), 16, 10).cast("bigint").alias("run_id"), F.lit(table_id).cast("bigint").alias("table_id"), "layer",
        began.alias("start_time"), F.col("run_timestamp").alias("end_time"), F.when(none, F.lit(EMPTY)).otherwise(F.lit(SUCCEEDED)).alias("status"),
        F.coalesce("rows_out", F.lit(0)).cast("bigint").alias("number_of_records"),
        F.when(none, F.concat(F.col("job_name"), F.lit(" kept no rows"))).alias("error_message"))
    return rows if runs is None else rows.join(runs.select("run_id"), "run_id", "left_anti")


# ---------------------------------------------------------------- reports

def run_summary(audit: DataFrame, rejects: DataFrame) -> DataFrame:
    """Per job: runs, rows in/out, rejected, duration; rejects joined by stage.

    ``rejects`` is F12 output (stage, reason, rejected).
    """
    per_stage = rejects.groupBy("stage").agg(F.sum("rejected").cast("bigint").alias("quarantined"))
    a = audit.groupBy("job_name", "stage").agg(
        F.count(F.lit(1)).cast("bigint").alias("runs"),
        F.sum("rows_in").cast("bigint").alias("rows_in"),
        F.sum("rows_out").cast("bigint").alias("rows_out"),
        F.sum("rows_rejected").cast("bigint").alias("rows_rejected"),
        F.round(F.sum("duration_seconds"), 3).alias("duration_seconds"))
    return a.join(per_stage, "stage", "left").withColumn(
        "quarantined", F.coalesce("quarantined", F.lit(0).cast("bigint")))


def job_status(audit: DataFrame, jobs: dict[str, str], since: str | None = None) -> DataFrame:
    """Every expected job (name -> stage) since a time: status, runs, records, rejected and duration, run or not.

    NOT_RUN without an audit row, EMPTY if the latest run kept no rows, else SUCCEEDED.
    """
    if since is not None:
        audit = audit.where(F.col("run_timestamp") >= F.lit(since).cast("timestamp"))
    got = audit.groupBy("job_name").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("rows_out").alias("records"), F.sum("rows_rejected").alias("rejected"),
        F.sum("duration_seconds").alias("seconds"), F.max(F.struct("run_timestamp", "rows_out")).alias("last"))
    expected = audit.sparkSession.createDataFrame(list(jobs.items()), "job_name string, stage string")
    status = F.when(F.col("runs").isNull(), F.lit(NOT_RUN)).when(F.coalesce("last.rows_out", F.lit(0)) == 0, F.lit(EMPTY)).otherwise(F.lit(SUCCEEDED))
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return expected.join(got, "job_name", "left").select("job_name", "stage", status.alias("status"), number("runs"), number("records"),
                                                         number("rejected"), F.round(F.coalesce("seconds", F.lit(0.0)), 3).alias("seconds"))


def run_totals(status: DataFrame) -> DataFrame:
    """Totals of ``job_status``: jobs expected, succeeded and not run, runs, rows rejected, seconds."""
    return status.agg(
        F.count(F.lit(1)).alias("jobs"), F.count_if(F.col("status") == SUCCEEDED).alias("succeeded"), F.count_if(F.col("status") == NOT_RUN).alias("not_run"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("runs", "rejected")], F.round(F.sum("seconds"), 3).alias("seconds"))


def run_tiles(audit: DataFrame, expected_jobs: int, first_stage: str, final_stage: str) -> DataFrame:
    """Steps done / expected, rows ingested, rows in the final layer, total rejected."""
    return audit.agg(
        F.count_distinct("job_name").cast("bigint").alias("steps_succeeded"),
        F.lit(expected_jobs).cast("bigint").alias("steps_expected"),
        F.coalesce(F.max(F.when(F.col("stage") == first_stage, F.col("rows_in"))), F.lit(0)).cast("bigint").alias("rows_ingested"),
        F.coalesce(F.max(F.when(F.col("stage") == final_stage, F.col("rows_out"))), F.lit(0)).cast("bigint").alias("rows_final"),
        F.coalesce(F.sum("rows_rejected"), F.lit(0)).cast("bigint").alias("rows_rejected"))


def count_chain(runs: DataFrame, layers: list[str]) -> DataFrame:
    """Counts of each layer's latest run side by side, retained and quarantined %."""
    last = latest_run(runs, ["table_id", "layer"]).where(F.col("layer").isin(layers))
    counts = last.groupBy("table_id").pivot("layer", layers).agg(F.first(int_or_zero("number_of_records")))
    first, final = layers[0], layers[-1]
    return counts.select(
        "table_id", *[int_or_zero(x).alias(x) for x in layers],
        F.round(F.col(final) * 100.0 / F.col(first), 1).alias("retained_pct"),
        F.round((F.col(first) - F.col(final)) * 100.0 / F.col(first), 1).alias("quarantined_pct"))


def report_outcome(report: DataFrame) -> DataFrame:
    """Per table: the first layer that did not reconcile (NULL when all did), and the verdict."""
    bad = F.col("evaluated") & ~F.col("reconciled")
    return report.groupBy("table_id").agg(
        F.min_by(F.when(bad, F.col("layer")), F.when(bad, F.col("seq"))).alias("stopped_at"),
        (F.count_if(bad) == 0).alias("all_reconciled"))


def reconcile_report(runs: DataFrame, rejects: DataFrame, layers: list[str] | None = None,
                     tables: DataFrame | None = None) -> DataFrame:
    """Walk the layers in order; stop at the first not-run, failed or unreconciled one.

    ``rejects``: (run_id, layer, rejected) totals per run. Output per table and
    layer: kept, rejected, expected, reconciled, evaluated (false after the stop), table_total.
    A layer that runs add up in hands its total to the next one, but its own run is judged by
    what that run kept: ``kept`` + ``rejected`` against the total of the layer before.
    """
    if "rows_kept" not in runs.columns:  # ledger rows without the split: one number is both
        runs = runs.withColumn("rows_kept", F.col("number_of_records"))
    layers = layers or [x for x in LAYER_ORDER if x not in REPORT_ONLY]
    last = latest_run(runs, ["table_id", "layer"])
    rej = rejects.groupBy("run_id").agg(F.sum("rejected").cast("bigint").alias("rejected"))
    steps = F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(n).alias("layer")) for i, n in enumerate(layers)])
    ids = (tables if tables is not None else runs).select("table_id").distinct()
    grid = ids.select("table_id", F.inline(steps))
    j = (grid.join(last, ["table_id", "layer"], "left").join(rej, "run_id", "left"))
    w = Window.partitionBy("table_id").orderBy("seq")
    prev_count = F.lag("number_of_records").over(w)
    ok = (F.col("status") == SUCCEEDED) & (
        (F.col("seq") == 0) |
        (F.coalesce(F.col("rows_kept"), F.col("number_of_records"), F.lit(0)) + F.coalesce(F.col("rejected"), F.lit(0)) == F.col("expected")))
    step = (j.withColumn("expected", prev_count)
            .withColumn("reconciled", F.coalesce(ok, F.lit(False))))
    run_ok = F.min(F.col("reconciled").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return step.select(
        "table_id", "seq", "layer", "run_id", "status",
        F.coalesce("rows_kept", "number_of_records").alias("kept"),
        F.coalesce("rejected", F.lit(0)).cast("bigint").alias("rejected"),
        "expected", "reconciled",
        F.coalesce(run_ok == 1, F.lit(True)).alias("evaluated"),
        F.col("number_of_records").alias("table_total"))

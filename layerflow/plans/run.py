"""Run the layers with write -> audit -> gate -> publish.

Per layer the tagged frame (all input rows plus ``_failure_reason``) is
written once, partitioned by ``_status`` = kept / rejected, into a folder
no reader sees yet. Counts per reason are observed by that write: nothing
is read again to count it. The gate
compares kept + rejected with the count the previous layer recorded; on a
match the kept folder is published as the layer and the rejected folder is
appended to the quarantine table, on a mismatch the kept rows go to
quarantine with the reason and nothing is published.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.functions import identity as ident
from layerflow.functions.text import month_date
from layerflow.operators.dedup import ROW_ID
from layerflow.operators.filters import overlap, require_any
from layerflow.operators.observed import ROWS, per_value
from layerflow.plans import layers as L
from layerflow.plans import ledger
from layerflow.sources.store import PART, Staged, TableStore, merge_frames

LOG = logging.getLogger(__name__)

STATUS = "_status"
REASON = "_failure_reason"
QUARANTINE = "failed"
RUNS = "pipeline_runs"
AUDIT = "audit"
DROP_ON_READ = [REASON, "_failed_stage", "_failed_at", "_run_id", L.ERRORS, L.VALID_ID, PART]


def with_row_id(df: DataFrame) -> DataFrame:
    """Unique, retry-stable row id of a Parquet scan (file path hash, row index)."""
    return df.select("*", F.struct(F.xxhash64(F.col("_metadata.file_path")).alias("f"),
                                   F.col("_metadata.row_index").alias("i")).alias(ROW_ID))


class GateError(RuntimeError):
    """Raised when a layer does not reconcile with the layer before it."""


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class LayerResult:
    stage: str
    status: str
    kept: int
    rejected: int
    by_reason: dict[str, int]
    expected: int | None
    reason: str
    seconds: float


@dataclass
class Runner:
    spark: SparkSession
    store: TableStore
    spec: L.LayerSpec = field(default_factory=L.LayerSpec)
    table_id: int = 1
    load_type: str = "FULL"
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    results: list[LayerResult] = field(default_factory=list)
    _last_run_id: int | None = None
    _work: list[str] = field(default_factory=list)
    batch_name: str = ""    # set per stream micro-batch: its name, the same in every replay
    batch_suffix: str = ""  # set per stream micro-batch so that each batch writes its own folder
    hashed_publish: str = "MERGE"  # "FULL" rewrites the hashed layer
    retract: bool = True    # a merged layer loses rows that a later run rejects (D19)

    # ------------------------------------------------------------ ledger
    def _next_run_id(self) -> int:
        """max(run_id) + 1 (F16); read once, then counted on (single writer)."""
        if self._last_run_id is None:
            runs = self.store.read(RUNS, schema=ledger.RUNS_SCHEMA)
            self._last_run_id = 0 if runs is None else ledger.next_run_id(runs).collect()[0]["next_run_id"] - 1
        self._last_run_id += 1
        return self._last_run_id

    def record_run(self, layer: str, status: str, count: int, message: str,
                   start: dt.datetime, kept: int | None = None) -> None:
        """Append one stage result row to ``pipeline_runs``.

        ``count`` is what the next layer will read, ``kept`` what this run has added to it, where they differ.
        """
        row = [(self._next_run_id(), self.table_id, layer, start, _now(), status, count, message, count if kept is None else kept)]
        self.store.append(self.spark.createDataFrame(row, ledger.RUNS_STORED), RUNS, rows=1)
        self.store.compact(RUNS)

    def record_audit(self, job: str, stage: str, rows_in: int, rows_out: int, rejected: int,
                     start: dt.datetime) -> None:
        """Append the job's audit row; a failure to write it is not fatal."""
        now = _now()
        row = [(uuid.uuid4().hex, job, stage, rows_in, rows_out, rejected, now,
                round((now - start).total_seconds(), 3))]
        try:
            self.store.append(self.spark.createDataFrame(row, ledger.AUDIT_SCHEMA), AUDIT, rows=1)
            self.store.compact(AUDIT)
        except Exception:  # noqa: BLE001 - the audit is best effort
            LOG.exception("audit row of %s/%s was not written", job, stage)

    def expected_count(self, previous: str) -> int | None:
        """Latest successful recorded count of the previous layer (E5)."""
        runs = self.store.read(RUNS, schema=ledger.RUNS_SCHEMA)
        if runs is None:
            return None
        last = ledger.latest_run(
            runs.where((F.col("layer") == previous) & (F.col("table_id") == self.table_id)
                       & F.col("number_of_records").isNotNull()),
            ["layer"], ledger.SUCCEEDED).collect()
        return None if not last else int(last[0]["number_of_records"])

    # ------------------------------------------------------------ one layer
    def run_layer(self, stage: str, previous: str, tagged: DataFrame,
                  publish: str = "load_type", reconcile_on: int | None = None) -> LayerResult:
        """Write the tagged rows once, gate, publish."""
        start = _now()
        t0 = time.perf_counter()
        out = (tagged.withColumnRenamed(L.OUTCOME, REASON)
               .drop(*[c for c in [ROW_ID] if c in tagged.columns])
               .withColumn(STATUS, F.when(F.col(REASON).isNull(), "kept").otherwise("rejected"))
               .withColumn("_failed_stage", F.lit(stage))
               .withColumn("_failed_at", F.lit(start))
               .withColumn("_run_id", F.lit(self.run_id)))
        parts = [STATUS]
        if self.spec.partition_by:
            out = out.withColumn(PART, F.col(self.spec.partition_by).cast("string"))
            parts.append(PART)
        path, seen = self.store.stage_counted(out, stage, name=self.batch_name or f"run={self.run_id}{self.batch_suffix}", partition_by=parts,
                                              metrics={"kept": F.count_if(F.col(REASON).isNull()), **per_value(REASON, L.REASONS)})
        kept, rejected = seen["kept"], seen[ROWS] - seen["kept"]
        counts = {r: seen[r] for r in L.REASONS if seen[r]}
        if sum(counts.values()) != rejected:  # a caller's own reasons: their rows alone are read
            counts = {r[REASON]: r["n"] for r in self.spark.read.parquet(f"{path}/{STATUS}=rejected")
                      .groupBy(REASON).agg(F.count(F.lit(1)).alias("n")).collect()}
        self.record_audit(ledger.LAYER_JOBS.get(stage, stage), stage, kept + rejected, kept, rejected, start)

        expected = self.expected_count(previous)
        status, reason = ledger.reconcile(kept if reconcile_on is None else reconcile_on,
                                          rejected if reconcile_on is None else 0,
                                          expected, stage, previous)
        kept_path, rej_path = f"{path}/{STATUS}=kept", f"{path}/{STATUS}=rejected"
        if status == ledger.MISMATCH:
            if rejected:  # routed before the gate, so not lost with the batch
                self._quarantine_segment(rej_path, rejected)
            if kept:  # they lie where the layer was staged: not written again for the reason's sake
                self.store.append_staged(QUARANTINE, [kept_path], kept, {REASON: reason})
            self.record_run(stage, ledger.MISMATCH, kept, reason, start)
            raise GateError(reason)
        if rejected:
            self._quarantine_segment(rej_path, rejected)
        self._publish(stage, kept_path, kept, publish)
        # the next layer reads the whole published table: an appended or merged layer records its total
        mode = (self.load_type if publish == "load_type" else publish).strip().upper()
        recorded = kept if mode == "FULL" else self.store.count(stage)
        self.record_run(stage, ledger.SUCCEEDED if kept else ledger.EMPTY, recorded, reason, start, kept)
        res = LayerResult(stage, status, kept, rejected, counts, expected, reason, time.perf_counter() - t0)
        self.results.append(res)
        return res

    def _quarantine_segment(self, path: str, n: int) -> None:
        self.store.append_segments(QUARANTINE, [path], n, self.store.current(QUARANTINE))

    def _publish(self, stage: str, kept_path: str, kept: int, publish: str) -> None:
        if kept == 0:
            return  # an empty batch keeps the old rows (D10), retractions included
        mode = (self.load_type if publish == "load_type" else publish).strip().upper()
        part = self.spec.partition_by
        # the published pieces: the kept folder, or its partition folders
        pieces = self.store.part_dirs(kept_path) if part else [kept_path]
        cur = self.store.current(stage)
        if cur is None or mode == "FULL":
            self.store.publish(stage, pieces, "overwrite", kept, DROP_ON_READ)
        elif mode == "APPEND":
            # a replayed batch takes the place of its earlier attempt
            self.store.append_segments(stage, pieces, kept, cur, DROP_ON_READ)
        else:
            batch = self.spark.read.parquet(kept_path).drop(*DROP_ON_READ)
            staged = Staged(pieces, kept, DROP_ON_READ)
            if mode == "REPLACE_MONTHS" and part:
                self.store.replace_partitions(batch, stage, part)
            elif mode == "REPLACE_MONTHS":
                self.store.replace_where_present(batch, stage, self.spec.month_col, staged)
            elif part:
                self.store.merge_partitioned(batch, stage, L.SURROGATE, part, retract=self.retract, staged=staged)
            else:
                self.store.merge(batch, stage, key=L.SURROGATE, retract=self.retract, staged=staged)

    # ------------------------------------------------------------ layers
    def read_layer(self, stage: str) -> DataFrame:
        df = self.store.read(stage)
        if df is None:
            raise GateError(f"{stage} has no published rows")
        return with_row_id(df)

    def ingest(self, manifest: DataFrame, landed: DataFrame, key: str = "dataset_id") -> DataFrame:
        """Datasets of the manifest that meet the month range, with the rows landed for each, as a recorded stage.

        ``landed`` has the key and ``rows`` (``landed_counts``). A dataset that has not landed shows 0 rows. No dataset
        in range is an error, recorded as FAILED; the message tells matched from landed datasets.
        """
        def load() -> DataFrame:
            start = _now()
            matched = require_any(overlap(manifest, self.spec.range_start, self.spec.range_end), "dataset of the manifest")
            found = matched.join(landed.select(key, "rows"), key, "left").select(
                *matched.columns, F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows_landed"))
            n, have, rows = found.agg(F.count(F.lit(1)), F.count_if(F.col("rows_landed") > 0), F.sum("rows_landed")).first()
            self.record_run("ingest", ledger.SUCCEEDED if have else ledger.EMPTY, rows, f"{have} of {n} matched datasets landed", start)
            return found
        return self.guarded("ingest", load)

    def raw(self, source: DataFrame, source_count: int | None = None,
            publish: str = "load_type") -> LayerResult:
        """Month-range filter and blank rows out; reconciled on the source count.

        ``publish="APPEND"`` adds the batch to the stored raw rows (stream micro-batches).
        """
        tagged = (source.withColumn(L.OUTCOME, F.when(L.all_null(source), F.lit(L.BLANK_ROW))
                                    .when(~L.in_range(source, self.spec), F.lit(L.OUTSIDE_RANGE)))
                  # the key exists before the first write, so raw can be merged too
                  .withColumn(L.SURROGATE, ident.surrogate_key(self.spec.natural_key)))
        if source_count is not None:
            self.record_run("source", ledger.SUCCEEDED, source_count, "landed", _now())
        if publish == "load_type" and self.load_type.strip().upper() != "FULL":
            publish = "REPLACE_MONTHS"  # landed rows have no unique key: a re-read month replaces itself
        return self.run_layer("raw", "source", tagged, publish=publish)

    def _written(self, stage: str):
        """A reuse hook that writes a narrow frame once and hands back a pruned Parquet scan.

        Category counts, ids and prices of passing rows, winners and group
        tables feed several consumers; writing them to the shared staging folder
        cuts the lineage (a lost executor re-reads files) and gives the counts
        behind a broadcast. They keep the row ids they refer to.
        """
        n = [0]

        def write(df: DataFrame) -> DataFrame:
            n[0] += 1
            path = self.store.stage_write(df, stage, name=f"work-{self.run_id}{self.batch_suffix}-{n[0]}")
            self._work.append(path)
            return self.spark.read.parquet(path)
        return write

    def _drop_work(self) -> None:
        """Delete the narrow frames of a layer whose rows are written."""
        self.store.discard(*self._work)
        self._work.clear()

    def guarded(self, stage: str, fn):
        """Run one layer; any failure other than the gate is recorded as FAILED."""
        start = _now()
        try:
            return fn()
        except GateError:
            raise
        except Exception as exc:
            self.record_run(stage, ledger.FAILED, 0, str(exc), start)
            raise

    def cleaned(self) -> LayerResult:
        tagged = L.tag_cleaned(self.read_layer("raw"), self.spec, self._written("cleaned"), check_small=True)
        result = self.run_layer("cleaned", "raw", tagged)
        self._drop_work()
        return result

    def transformed(self) -> LayerResult:
        tagged = L.tag_transformed(self.read_layer("cleaned"), self.spec, self._written("transformed"),
                                   check_small=True)
        result = self.run_layer("transformed", "cleaned", tagged)
        self._drop_work()
        return result

    def hashed(self) -> LayerResult:
        tagged = L.tag_hashed(self.read_layer("transformed")).drop(L.IDENTIFIER)
        return self.run_layer("hashed", "transformed", tagged, publish=self.hashed_publish)

    # ------------------------------------------------------------ incremental loop
    def setting(self, name: str, default: str) -> str:
        """A table parameter from the stored ``table_parameters`` ledger table (A4)."""
        params = self.store.read("table_parameters", schema=ledger.LEDGER_SCHEMAS["table_parameters"])
        if params is None:
            return default
        row = ledger.parameter(params, self.table_id, name, default).collect()
        return row[0]["parameter_value"] if row else default

    def watermark(self) -> str | None:
        """This table's stored watermark, if any (A5)."""
        marks = self.store.read("table_watermarks", schema=ledger.LEDGER_SCHEMAS["table_watermarks"])
        if marks is None:
            return None
        row = (marks.where(F.col("table_id") == self.table_id)
               .agg(F.max_by("last_watermark_value", "last_updated_at").alias("w")).collect())
        return row[0]["w"] if row else None

    def window(self):
        """The months to (re)load this run (K2), from parameters and the watermark."""
        from layerflow.streaming.incremental import effective_window
        self.load_type = self.setting("load_type", self.load_type).strip().upper()
        lookback = int(self.setting("lookback_window", "7"))
        return effective_window(self.load_type, self.watermark(), self.spec.range_start, self.spec.range_end, lookback,
                                months=True)

    def advance_watermark(self, value: str) -> bool:
        """After a successful non-FULL run, store the new watermark and verify it."""
        if self.load_type.strip().upper() == "FULL":
            return False
        schema = ledger.LEDGER_SCHEMAS["table_watermarks"]
        row = self.spark.createDataFrame([(self.table_id, value, _now(), self._last_run_id)], schema)
        current = self.store.read("table_watermarks", schema=schema)
        merged = row if current is None else merge_frames(current, row, "table_id")
        self.store.overwrite(merged, "table_watermarks")
        check = ledger.verify_present(self.store.read("table_watermarks", schema=schema),
                                      row.select("table_id", "last_watermark_value"),
                                      ["table_id", "last_watermark_value"]).collect()
        if not all(r.present for r in check):
            raise RuntimeError("watermark write not visible after publish")
        return True

    def incremental(self, source: DataFrame) -> list[LayerResult]:
        """Window -> filter the source -> all layers -> advance the watermark.

        The window filter is a predicate on the month column, so it reaches
        the scan; the new watermark is the latest month processed (D14).
        """
        from layerflow.operators.filters import date_range
        lo, hi = self.window()
        batch = date_range(source, self.spec.month_col, lo.isoformat(), hi.isoformat(), prune=True)
        results = self.all_layers(batch, batch.count())
        latest = batch.agg(F.date_format(F.max(month_date(self.spec.month_col)), "yyyy-MM-dd 00:00:00").alias("m")).first()["m"]
        if latest is not None:
            self.advance_watermark(latest)
        return results

    def all_layers(self, source: DataFrame, source_count: int | None = None) -> list[LayerResult]:
        """raw -> cleaned -> transformed -> hashed; the first failure stops the chain."""
        self.guarded("raw", lambda: self.raw(source, source_count))
        self.guarded("cleaned", self.cleaned)
        self.guarded("transformed", self.transformed)
        self.guarded("hashed", self.hashed)
        return self.results

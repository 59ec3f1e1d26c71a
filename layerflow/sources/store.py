"""Layer tables as Parquet snapshots with a publish log.

A stage lives under ``<root>/<stage>/``. Every write goes to a new data
folder that nobody reads yet; it becomes the table's content only when a
row naming it is appended to ``<root>/<stage>/_log`` (publish). Readers
take the log row with the highest ``seq``. So a full reload never
overwrites the files it reads, a failed job leaves the old content in
place, earlier versions stay readable, and a retry of the same batch id
rewrites its own folder instead of adding rows twice.

This is the part a row-level table format would do; when the session has
a catalog with MERGE support, ``merge`` can be swapped for
``DataFrame.mergeInto`` without touching the layer plans.
"""

from __future__ import annotations

import datetime as dt
import re
import time
import urllib.parse
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.operators.dedup import assert_unique
from layerflow.operators.groups import join_small
from layerflow.operators.observed import ROWS, write_observed
from layerflow.session import freed_shuffles

LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("segments", T.ArrayType(T.StringType())),
    T.StructField("mode", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("drop_columns", T.ArrayType(T.StringType())),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("fills", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))),
])

PART = "_part"  # folder column of partitioned layouts (a copy of the partition column)

# Load types that select a full reload or a merge.
FULL_LOAD = {"FULL"}
MERGE_LOAD = {"MERGE", "INCREMENTAL", "UPSERT"}


@dataclass
class Version:
    seq: int
    segments: list[str]
    mode: str
    rows: int
    drop_columns: list[str]
    fills: dict[str, dict[str, str]] = field(default_factory=dict)  # by segment: columns whose value is one for all its rows


@dataclass
class Staged:
    """A batch that is written already: its folders, rows, and columns that readers don't see."""
    segments: list[str]
    rows: int
    drop_columns: list[str]


PUBLISH_TRIES = 5   # appends try again on what another writer published
CLAIM_WAITS = 25    # fifths of a second to wait for a claimed version to appear in the log


class ConcurrentWrite(RuntimeError):
    """Another writer published the stage meanwhile; nothing of this write is visible."""


@dataclass
class WriteStats:
    """Rows before, after and the change of one write."""
    before: int
    after: int

    @property
    def delta(self) -> int:
        return self.after - self.before


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log: dict[str, list[Version]] = {}  # kept until another writer has claimed a version

    # ------------------------------------------------------------ layout
    def _log_path(self, stage: str) -> str:
        return f"{self.root}/{stage}/_log"

    def new_data_path(self, stage: str, name: str | None = None) -> str:
        return f"{self.root}/{stage}/data/{name or uuid.uuid4().hex}"

    # ------------------------------------------------------------ log
    def versions(self, stage: str) -> list[Version]:
        known = self._log.get(stage)
        if known is None or self._claimed(stage) > (known[-1].seq if known else 0):
            known = self._log[stage] = self._read_log(stage)
        return known

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _claimed(self, stage: str) -> int:
        """Highest version number that a writer has claimed; a listing of empty files, no Spark job."""
        fs, folder = self._fs(f"{self.root}/{stage}/_claims")
        return max((int(f.getPath().getName()) for f in fs.listStatus(folder)), default=0) if fs.exists(folder) else 0

    def _claim(self, stage: str, seq: int) -> bool:
        """Create the claim of a version if nobody has: one of two writers gets it."""
        fs, p = self._fs(f"{self.root}/{stage}/_claims/{seq}")
        return fs.createNewFile(p)

    def _settled(self, stage: str) -> Version | None:
        """The current version once claimed ones are in the log; a claim whose writer died is passed over."""
        for _ in range(CLAIM_WAITS):
            cur = self.current(stage)
            if self._claimed(stage) <= (cur.seq if cur else 0):
                return cur
            time.sleep(0.2)
            self._log.pop(stage, None)
        return self.current(stage)

    def _read_log(self, stage: str) -> list[Version]:
        try:
            rows = self.spark.read.schema(LOG_SCHEMA).parquet(self._log_path(stage)).collect()
        except Exception as exc:  # no log yet: the table does not exist
            if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
                return []
            raise
        out = [Version(r.seq, list(r.segments), r.mode, r.rows, list(r.drop_columns or []), r.fills or {}) for r in rows]
        return sorted(out, key=lambda v: v.seq)

    def current(self, stage: str, seq: int | None = None) -> Version | None:
        vs = self.versions(stage)
        if seq is not None:
            vs = [v for v in vs if v.seq == seq]
        return vs[-1] if vs else None

    def exists(self, stage: str) -> bool:
        return self.current(stage) is not None

    def publish(self, stage: str, segments: list[str], mode: str, rows: int,
                drop_columns: list[str] | None = None, based_on: int | None = None,
                fills: dict[str, dict[str, str]] | None = None) -> Version:
        """Make ``segments`` the stage's content (one appended log row).

        ``fills`` gives, by segment, text columns that readers see with one value in all its rows,
        whatever its files hold; a segment that stays keeps them.

        ``based_on`` is the version that the segments were derived from (0: none). If another writer
        has published meanwhile, or claims the same number, nothing is published and
        ``ConcurrentWrite`` is raised.
        """
        cur = self._settled(stage)
        if based_on is not None and (cur.seq if cur else 0) != based_on:
            raise ConcurrentWrite(f"{stage}: version {based_on} was read, but {cur.seq if cur else 0} is current")
        seq = max(cur.seq if cur else 0, self._claimed(stage)) + 1
        if not self._claim(stage, seq):
            raise ConcurrentWrite(f"{stage}: version {seq} was claimed by another writer")
        fills = {s: f for s, f in {**(cur.fills if cur else {}), **(fills or {})}.items() if s in segments}
        row = [(seq, segments, mode, rows, drop_columns or [], dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), fills)]
        self.spark.createDataFrame(row, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self._log_path(stage))
        v = Version(seq, segments, mode, rows, drop_columns or [], fills)
        self._log.setdefault(stage, []).append(v)
        return v

    # ------------------------------------------------------------ read
    def read(self, stage: str, seq: int | None = None,
             schema: T.StructType | None = None) -> DataFrame | None:
        """Published content of a stage (A3); ``seq`` reads an older version.

        Segments may differ in columns (schema evolution); their schemas are
        merged unless the caller knows the schema (ledger tables).
        """
        v = self.current(stage, seq)
        if v is None:
            return None
        df = self._rows(v.segments, v.fills, schema)
        return df.drop(*[c for c in v.drop_columns if c in df.columns])

    def _rows(self, segments: list[str], fills: dict[str, dict[str, str]], schema: T.StructType | None = None) -> DataFrame:
        """Rows of segments, internal columns included; those with the same fills are one scan."""
        groups: dict[tuple, list[str]] = {}
        for s in segments:
            groups.setdefault(tuple(sorted(fills.get(s, {}).items())), []).append(s)
        parts = []
        for filled, some in groups.items():
            # segments are folders of files, some of them by partition: the columns are all in the files
            reader = self.spark.read.option("recursiveFileLookup", "true")
            if schema is not None:
                reader = reader.schema(schema)
            elif len(some) > 1:
                reader = reader.option("mergeSchema", "true")
            parts.append(reader.parquet(*some).withColumns({c: F.lit(value) for c, value in filled}))
        return union_by_name(parts)

    def count(self, stage: str) -> int:
        v = self.current(stage)
        return 0 if v is None else v.rows

    # ------------------------------------------------------------ write
    def stage_write(self, df: DataFrame, stage: str, name: str | None = None,
                    partition_by: list[str] | None = None) -> str:
        """Write rows where no reader looks yet: every attempt has a folder of its own.

        Attempts of one ``name`` share ``attempt_base``, by which a publish replaces the earlier one.
        """
        path = self._attempt_path(stage, name)
        w = df.write.mode("errorifexists").option("compression", "zstd")  # keys are hex text: half the bytes
        if partition_by:
            w = w.partitionBy(*partition_by)
        with freed_shuffles(df.sparkSession):
            w.parquet(path)
        return path

    def discard(self, *paths: str) -> None:
        """Delete staged folders that nothing published or still to come reads."""
        for path in paths:
            fs, p = self._fs(path)
            fs.delete(p, True)

    def stage_counted(self, df: DataFrame, stage: str, name: str | None = None, partition_by: list[str] | None = None,
                      metrics: dict[str, Column] | None = None) -> tuple[str, dict[str, int]]:
        """``stage_write`` with the counts that the write observed (``rows`` and ``metrics``)."""
        path = self._attempt_path(stage, name)
        return path, write_observed(df, path, partition_by or (), metrics)

    def _attempt_path(self, stage: str, name: str | None) -> str:
        return self.new_data_path(stage, f"{name}~{uuid.uuid4().hex[:8]}" if name else None)

    @staticmethod
    def attempt_base(path: str) -> str:
        """A segment's path without what tells attempts apart."""
        return re.sub(r"~[0-9a-f]{8}", "", path)

    def overwrite(self, df: DataFrame, stage: str) -> WriteStats:
        """Full reload (B3): new content and schema; an empty batch keeps the old rows."""
        before = self.count(stage)
        path, seen = self.stage_counted(df, stage)
        n = seen[ROWS]
        if n == 0:
            return WriteStats(before, before)
        self.publish(stage, [path], "overwrite", n)
        return WriteStats(before, n)

    def append(self, df: DataFrame, stage: str, batch_id: str | None = None,
               rows: int | None = None) -> WriteStats:
        """Append (B2); with ``batch_id`` a repeated batch replaces itself.

        ``rows``: the number the caller knows (a ledger row), in place of the observed one.
        """
        path, seen = self.stage_counted(df, stage, f"batch={batch_id}" if batch_id else None)
        return self.append_staged(stage, [path], seen[ROWS] if rows is None else rows)

    def append_staged(self, stage: str, paths: list[str], n: int, fill: dict[str, str] | None = None) -> WriteStats:
        """Append ``n`` rows that are written already; ``fill``: see ``publish``."""
        for attempt in range(PUBLISH_TRIES):
            cur = self._settled(stage)
            before = cur.rows if cur else 0
            if n == 0:
                return WriteStats(before, before)
            try:
                after = self.append_segments(stage, paths, n, cur, fill=fill)
                return WriteStats(before, after)
            except ConcurrentWrite:  # another writer came first: append to what it published
                self._log.pop(stage, None)
                if attempt == PUBLISH_TRIES - 1:
                    raise
        raise AssertionError

    def append_segments(self, stage: str, paths: list[str], rows: int, cur: Version | None,
                        drop_columns: list[str] | None = None, fill: dict[str, str] | None = None) -> int:
        """Publish written segments beside the current ones; an earlier attempt of the same name goes. ``fill``: see ``publish``."""
        segments = list(cur.segments) if cur else []
        names = {self.attempt_base(p) for p in paths}
        old = [s for s in segments if self.attempt_base(s) in names]
        gone = self.spark.read.option("mergeSchema", "true").parquet(*old).count() if old else 0
        after = (cur.rows if cur else 0) - gone + rows
        drop = drop_columns if drop_columns is not None else (cur.drop_columns if cur else [])
        self.publish(stage, [s for s in segments if s not in old] + paths, "append", after, drop,
                     based_on=cur.seq if cur else 0, fills={p: fill for p in paths} if fill else None)
        return after

    def compact(self, stage: str, max_segments: int = 64, files: int = 1) -> bool:
        """Rewrite a table made of many small appended segments as one (ledger tables).

        The old segments stay readable as the previous version; readers switch
        at the publish.
        """
        cur = self.current(stage)
        if cur is None or len(cur.segments) <= max_segments:
            return False
        df = self.read(stage)
        path = self.stage_write(df.coalesce(files), stage)
        self.publish(stage, [path], "compact", cur.rows, based_on=cur.seq)
        return True

    def merge(self, df: DataFrame, stage: str, key: str = "surrogate_key",
              check_unique: bool = True, retract: bool = False, staged: Staged | None = None) -> WriteStats:
        """Upsert by key (B4); the first write is a plain append.

        ``retract``: ``df`` is all that the layer has to hold, so stored keys that it lacks (rows that
        are rejected from now on, or gone upstream) are removed (D19). ``staged`` says where ``df``, whose
        keys are never null, is written already: see ``_whole``.
        """
        base = self.current(stage)
        cur = self.read(stage, base.seq) if base else None
        before = self.count(stage)
        if cur is None:
            return self.append(df, stage)
        if check_unique:
            assert_unique(df, [key])
        if retract and staged is not None and self._whole(df, cur):
            self.publish(stage, staged.segments, "merge", staged.rows, staged.drop_columns, based_on=base.seq)
            return WriteStats(before, staged.rows)
        small = df.count() <= MERGE_BROADCAST_ROWS  # a small batch: the stored table is not shuffled
        deletes = retractions(cur, df, key, small) if retract else None
        merged = merge_frames(cur, df, key, broadcast_batch=small, deletes=deletes)
        path, seen = self.stage_counted(merged, stage)
        n = seen[ROWS]
        self.publish(stage, [path], "merge", n, based_on=base.seq)
        return WriteStats(before, n)

    @staticmethod
    def _whole(df: DataFrame, cur: DataFrame) -> bool:
        """Whether a batch that retracts what it lacks also has every stored column: every stored row is then
        updated in all its columns or removed, and the merged layer is the batch itself."""
        return set(cur.dtypes) <= set(df.dtypes)

    def replace_where_present(self, df: DataFrame, stage: str, col: str, staged: Staged | None = None) -> WriteStats:
        """Replace every row whose ``col`` value occurs in the batch, keep the rest.

        For tables without a unique key (landed rows may hold exact copies):
        re-loading a month replaces that month. The batch's distinct values
        are few and broadcast by AQE; nothing is grouped by a hot value.
        Only segments that hold one of the values are written again; ``staged``
        says where ``df`` is written already, so its rows are published as they are.
        """
        cur = self.current(stage)
        before = self.count(stage)
        if cur is None:
            return self.append(df, stage)
        values = df.select(col).distinct()  # a month may hold a third of the rows: never shuffle by it
        files = [urllib.parse.unquote(r[0]) for r in join_small(
            self._segments(cur.segments).select(col, F.col("_metadata.file_path").alias("_file")), values, [col],
            how="left_semi", check=True).select("_file").distinct().collect()]
        touched = [s for s in cur.segments if any(f"{urllib.parse.unquote(s)}/" in f for f in files)]
        if any(not any(f"{urllib.parse.unquote(s)}/" in f for s in touched) for f in files):
            touched = list(cur.segments)  # paths that can't be told apart: every segment is written again
        segments, after, parts = [s for s in cur.segments if s not in touched], cur.rows, [] if staged else [df]
        if touched:
            old = self._rows(touched, cur.fills)
            after -= old.count()
            old = old.drop(*[c for c in cur.drop_columns if c in old.columns])
            parts.insert(0, join_small(old, values, [col], how="left_anti", check=True))
        if parts:
            path, seen = self.stage_counted(union_by_name(parts), stage)
            after += seen[ROWS]
            segments += [path] if seen[ROWS] else []
        drop = cur.drop_columns
        if staged:
            segments, after = segments + staged.segments, after + staged.rows
            drop = list(dict.fromkeys([*drop, *staged.drop_columns]))
        self.publish(stage, segments, "replace", after, drop)
        return WriteStats(before, after)

    def _segments(self, paths: list[str]) -> DataFrame:
        """Rows of some segments, internal columns included."""
        return self.spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(*paths)

    # ------------------------------------------------------------ partitioned layout
    def part_dirs(self, path: str) -> list[str]:
        """Partition folders under ``path`` (a listing job; only folder names reach the driver)."""
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(path).select("path"))
        folder = F.regexp_extract(F.col("path"), rf"^(.*/{PART}=[^/]*)/[^/]*$", 1).alias("d")
        return sorted(r.d for r in files.select(folder).distinct().collect() if r.d)

    @staticmethod
    def _value_of(segment: str) -> str | None:
        """Partition value of a folder: unescaped, None for the folder of nulls."""
        value = segment.rsplit(f"{PART}=", 1)[1]
        return None if value == "__HIVE_DEFAULT_PARTITION__" else urllib.parse.unquote(value)

    def write_partitioned(self, df: DataFrame, stage: str, col: str) -> tuple[list[str], int]:
        """Write rows into one folder per value of ``col`` (the column stays in the files too)."""
        path, seen = self.stage_counted(df.withColumn(PART, F.col(col).cast("string")), stage, partition_by=[PART])
        return self.part_dirs(path), seen[ROWS]

    def overwrite_partitioned(self, df: DataFrame, stage: str, col: str) -> WriteStats:
        before = self.count(stage)
        dirs, n = self.write_partitioned(df, stage, col)
        if n == 0:
            return WriteStats(before, before)
        self.publish(stage, dirs, "overwrite", n)
        return WriteStats(before, n)

    def _rewrite_touched(self, df: DataFrame, stage: str, col: str, combine, deletes: DataFrame | None = None) -> WriteStats:
        cur = self.current(stage)
        if cur is None:
            return self.overwrite_partitioned(df, stage, col)
        if not all(f"/{PART}=" in seg for seg in cur.segments):
            raise ValueError(f"{stage} is not stored by partition")
        changed = df.select(F.col(col).cast("string"))
        if deletes is not None:
            changed = changed.unionByName(deletes.select(F.col(col).cast("string")))
        touched = {r[0] for r in changed.distinct().collect()}
        old = [seg for seg in cur.segments if self._value_of(seg) in touched]
        keep = [seg for seg in cur.segments if self._value_of(seg) not in touched]
        old_df = None
        old_rows = 0
        if old:
            old_df = self.spark.read.parquet(*old)
            old_rows = old_df.count()  # only the touched folders are counted
            old_df = old_df.drop(*[c for c in cur.drop_columns + [PART] if c in old_df.columns])
        kept_rows = cur.rows - old_rows  # the published total is exact: untouched folders are not read
        dirs, n = self.write_partitioned(combine(old_df, df), stage, col)
        # untouched folders keep their internal columns: keep hiding them on read
        self.publish(stage, keep + dirs, "merge", kept_rows + n, cur.drop_columns, based_on=cur.seq)
        return WriteStats(cur.rows, kept_rows + n)

    def merge_partitioned(self, df: DataFrame, stage: str, key: str, col: str,
                          check_unique: bool = True, retract: bool = False, staged: Staged | None = None) -> WriteStats:
        """Upsert by key, rewriting only the partitions the batch touches (B4 at scale).

        Requires that a key always lies in the same partition (true when the
        partition column is part of the key, as the month is of the natural key).
        """
        if check_unique:
            assert_unique(df, [key])
        base = self.current(stage)
        cur = self.read(stage) if retract else None
        if cur is not None and staged is not None and self._whole(df, cur):
            self.publish(stage, staged.segments, "merge", staged.rows, staged.drop_columns, based_on=base.seq)
            return WriteStats(base.rows, staged.rows)
        small = df.count() <= MERGE_BROADCAST_ROWS
        deletes = retractions(cur, df, key, small, col) if cur is not None else None
        return self._rewrite_touched(
            df, stage, col,
            lambda old, new: new if old is None else merge_frames(old, new, key, broadcast_batch=small, deletes=deletes), deletes)

    def replace_partitions(self, df: DataFrame, stage: str, col: str) -> WriteStats:
        """Replace the partitions present in the batch; the others are published untouched."""
        return self._rewrite_touched(df, stage, col, lambda old, new: new)

    def write_by_load_type(self, df: DataFrame, stage: str, load_type: str,
                           key: str = "surrogate_key") -> WriteStats:
        """Full reload or merge, chosen by the table's ``load_type`` parameter."""
        lt = (load_type or "FULL").strip().upper()
        if lt in FULL_LOAD:
            return self.overwrite(df, stage)
        if lt in MERGE_LOAD:
            return self.merge(df, stage, key)
        raise ValueError(f"unknown load_type {load_type!r}: expected FULL or MERGE/INCREMENTAL/UPSERT")


def retractions(stored: DataFrame, kept: DataFrame, key: str, broadcast_kept: bool = False, *carry: str) -> DataFrame:
    """Stored keys (and ``carry`` columns) that ``kept``, all that the layer has to hold, lacks."""
    keys = kept.select(key)
    return stored.select(key, *carry).join(F.broadcast(keys) if broadcast_kept else keys, key, "left_anti")


# Largest batch (whole rows) a merge broadcasts so that the stored table is never shuffled.
MERGE_BROADCAST_ROWS = 200_000


def merge_frames(target: DataFrame, batch: DataFrame, key: str, broadcast_batch: bool = False,
                 deletes: DataFrame | None = None) -> DataFrame:
    """Target rows updated/inserted from the batch by key, and those of ``deletes`` removed.

    ``deletes`` (one column, the key) travels in the same join as the batch, as rows
    that only say *gone*; a key that the batch has as well is updated, not removed.

    Matched: every column the batch has takes the batch value; target
    columns the batch lacks keep the old value. Not matched: inserted.
    Columns only the batch has are added (old rows read NULL).
    Default: one full outer join on the key; both sides shuffle by key once.
    ``broadcast_batch`` (for a batch of checked size): the stored rows stream
    past the broadcast batch in a left join, the matched keys come from a
    one-column scan of the stored keys against the broadcast batch keys, and
    the unmatched batch rows are added — the same rows, without an exchange
    of the stored table.
    """
    t_cols = target.columns
    b_cols = batch.columns
    out_cols = t_cols + [c for c in b_cols if c not in t_cols]
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in t_cols])
    b = batch.select(*[F.col(c).alias(f"b__{c}") for c in b_cols], F.lit(True).alias("b__present"))
    if deletes is not None:
        gone = deletes.select(F.col(key)).distinct().join(batch.select(key), key, "left_anti")
        b = b.withColumn("b__gone", F.lit(False)).unionByName(
            gone.select(F.col(key).alias(f"b__{key}"), F.lit(True).alias("b__gone")), allowMissingColumns=True)
    same_key = F.col(f"t__{key}") == F.col(f"b__{key}")
    if not broadcast_batch:
        j = t.join(b, same_key, "full_outer")
    else:
        stored = t.join(F.broadcast(b), same_key, "left")
        batch_keys = F.broadcast(batch.select(F.col(key).alias("_mk")).distinct())
        matched = target.select(F.col(key).alias("_mk")).join(batch_keys, "_mk").distinct()
        inserted = b.join(matched, F.col(f"b__{key}") == F.col("_mk"), "left_anti")
        nulls = [F.lit(None).cast(target.schema[c].dataType).alias(f"t__{c}") for c in t_cols]
        j = stored.unionByName(inserted.select(*nulls, *inserted.columns))
    if deletes is not None:
        j = j.where(~F.coalesce(F.col("b__gone"), F.lit(False)))
    hit = F.col("b__present").isNotNull()
    cols = []
    for c in out_cols:
        if c in b_cols and c in t_cols:
            cols.append(F.when(hit, F.col(f"b__{c}")).otherwise(F.col(f"t__{c}")).alias(c))
        elif c in b_cols:
            cols.append(F.col(f"b__{c}").alias(c))
        else:
            cols.append(F.col(f"t__{c}").alias(c))
    return j.select(*cols)


def merge_stats(target: DataFrame, batch: DataFrame, key: str, broadcast_batch: bool = False) -> DataFrame:
    """Rows before / after / inserted / updated of a merge, as the full outer join counts them.

    Default: one full outer join of the key columns. ``broadcast_batch`` (for
    a batch of checked size): the batch's rows per key are broadcast and
    joined onto the stored keys on the map side — a stored row stands for
    ``max(nb, 1)`` joined rows, ``nb`` of them updates — and the inserted rows
    are the batch rows whose key matched nothing. Same numbers, no exchange
    of the stored keys.
    """
    if broadcast_batch:
        per_key = F.broadcast(batch.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_nb")))
        t = target.select(F.col(key).alias("_k")).join(per_key, "_k", "left").select(
            "_k", F.coalesce("_nb", F.lit(0)).alias("_nb"))
        zero = F.lit(0).cast("bigint")

        def part(before, updated, matched, rows):
            return [before.cast("bigint").alias("_before"), updated.cast("bigint").alias("_updated"),
                    matched.cast("bigint").alias("_matched"), rows.cast("bigint").alias("_batch")]

        # each input row contributes its share; one global sum adds them up
        parts = (t.select(*part(F.greatest("_nb", F.lit(1)), F.col("_nb"), zero, zero))
                 .unionByName(t.where(F.col("_nb") > 0).select("_k", "_nb").distinct()
                              .select(*part(zero, zero, F.col("_nb"), zero)))
                 .unionByName(batch.select(*part(zero, zero, zero, F.lit(1)))))
        one = parts.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ["_before", "_updated", "_matched", "_batch"]])
        inserted = F.col("_batch") - F.col("_matched")
        return one.select(
            F.col("_before").alias("rows_before"),
            (F.col("_before") + inserted).cast("bigint").alias("rows_after"),
            inserted.cast("bigint").alias("rows_inserted"),
            F.col("_updated").alias("rows_updated"))
    t = target.select(F.col(key).alias("_k")).withColumn("_t", F.lit(1))
    b = batch.select(F.col(key).alias("_k")).withColumn("_b", F.lit(1))
    j = t.join(b, "_k", "full_outer")
    return j.agg(
        F.count("_t").cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).cast("bigint").alias("rows_after"),
        F.count_if(F.col("_t").isNull()).cast("bigint").alias("rows_inserted"),
        F.count_if(F.col("_t").isNotNull() & F.col("_b").isNotNull()).cast("bigint").alias("rows_updated"),
    )


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union all, matching columns by name; a missing column reads NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

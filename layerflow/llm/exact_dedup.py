"""Exact dedup: static binary-fuse filters of an immutable snapshot screen incoming digests.

A snapshot is a written table with one row per distinct digest, dealt into
hash buckets of bounded size, plus one binary-fuse filter per bucket. A new
batch is first reduced to its distinct digests (map-side combine, so a group of
copies that holds a third of all rows arrives as one row per task), each digest
is probed in its bucket's filter, and only the positives are joined to the
snapshot's buckets. Digests that the filter turns away are new for certain;
copies among them are grouped separately. Whatever shares a digest is then
compared byte for byte: the texts of all members of a group are grouped by
(digest, text), which also collapses copies on the map side, and a digest with
two different texts is split into one group per text.

Defined results: a null text counts as empty; empty texts are copies of each
other; rows that repeat a doc_id with an equal text are all marked kept if
that doc_id is the smallest of its group; a null doc_id counts in group_size,
sorts after all others, and a group of nulls only has keep_id null and kept
false; an empty table gives an empty result. Other columns, whatever their
names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.llm.common import SPACES, ship_code, text_or_empty, written

BUCKET_ROWS = 250_000  # distinct digests of a bucket, on average: one filter is built in one task
FINGERPRINT = np.uint16


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), f"[{SPACES}]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


# ---------------------------------------------------------------- the filter

def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _shape(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of segments for n keys."""
    length = 1 << max(2, min(18, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    slots = int(np.ceil(max(n, 1) * factor)) + 32
    return length, max(1, -(-slots // length) - 2)


def _slots(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots in adjacent segments and the fingerprint of each key."""
    with np.errstate(over="ignore"):
        h = _mix(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    mask = np.uint64(length - 1)
    at = np.stack([(first + np.uint64(j)) * np.uint64(length) + (_mix(h + np.uint64(j + 1)) & mask) for j in range(3)], axis=1)
    return at.astype(np.int64), (h & np.uint64(0xFFFF)).astype(FINGERPRINT)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Binary-fuse filter of distinct uint64 keys: (seed, segment length, segments, slots)."""
    keys = np.unique(keys.astype(np.uint64))
    length, segments = _shape(len(keys))
    for seed in range(1, 200):
        if seed % 20 == 0:
            segments += max(1, segments // 8)
        slots, prints = _slots(keys, seed, length, segments)
        size = (segments + 2) * length
        order, left = [], np.arange(len(keys))
        degree = np.zeros(size, np.int64)
        owner = np.zeros(size, np.int64)  # xor of the keys' numbers: the key itself where the degree is 1
        for j in range(3):
            np.add.at(degree, slots[:, j], 1)
            np.bitwise_xor.at(owner, slots[:, j], left)
        alive = np.ones(len(keys), bool)
        while True:  # peel all slots that hold a single key, a round at a time
            single = np.flatnonzero(degree == 1)
            if not len(single):
                break
            keys_now, index = np.unique(owner[single], return_index=True)
            order.append((keys_now, single[index]))
            alive[keys_now] = False
            for j in range(3):
                np.subtract.at(degree, slots[keys_now, j], 1)
                np.bitwise_xor.at(owner, slots[keys_now, j], keys_now)
        if alive.any():
            continue
        table = np.zeros(size, FINGERPRINT)
        for keys_now, at in reversed(order):  # a round's keys share no slot that one of them fills
            others = np.zeros(len(keys_now), FINGERPRINT)
            for j in range(3):
                others ^= np.where(slots[keys_now, j] == at, FINGERPRINT(0), table[slots[keys_now, j]])
            table[at] = prints[keys_now] ^ others
        return seed, length, segments, table.tobytes()
    raise RuntimeError("no seed gave an acyclic assignment")


def probe_filter(keys: np.ndarray, seed: int, length: int, segments: int, raw: bytes) -> np.ndarray:
    """True for every key that the filter holds, and for one in 65,536 of the others."""
    slots, prints = _slots(keys.astype(np.uint64), seed, length, segments)
    table = np.frombuffer(raw, FINGERPRINT)
    return (table[slots[:, 0]] ^ table[slots[:, 1]] ^ table[slots[:, 2]]) == prints


# ---------------------------------------------------------------- snapshot and batch

@dataclass(frozen=True)
class Snapshot:
    """Immutable: digests (bucket, digest, min_id, n) and filters (bucket, ...), both written."""

    digests: DataFrame
    filters: DataFrame
    buckets: int


def digest_rows(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """doc_id, digest, text_sha256 and a hash of the raw text of each row, written once: a narrow table.

    The raw hash only tells rows with one (or no) doc_id apart when their texts are fetched again.
    """
    text = normalised()
    return written(docs.select("doc_id", digest(text).alias("digest"), F.xxhash64(text_or_empty()).alias("raw"),
                               *([] if digest is sha256 else [sha256(text).alias("text_sha256")])), "digests")


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min("doc_id").alias("min_id"), F.count(F.lit(1)).alias("n"))


def _bucketed(grouped: DataFrame, buckets: int) -> DataFrame:
    key = F.xxhash64("digest")
    return grouped.withColumns({"key": key, "bucket": F.pmod(F.shiftrightunsigned(key, 7), F.lit(buckets)).cast("int")})


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    seed, length, segments, raw = build_filter(pdf["key"].to_numpy(np.int64).view(np.uint64))
    return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "seed": [seed], "length": [length], "segments": [segments], "slots": [raw]})


def build_snapshot(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> Snapshot:
    """Snapshot of ``rows`` (doc_id, digest)."""
    ship_code(rows.sparkSession)
    grouped = _grouped(rows)
    buckets = max(1, -(-rows.count() // bucket_rows))
    digests = written(_bucketed(grouped, buckets), "snapshot")
    filters = digests.select("bucket", "key").groupBy("bucket").applyInPandas(
        _build, "bucket int, seed int, length int, segments int, slots binary")
    return Snapshot(digests, written(filters, "filters"), buckets)


def _screen(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    hit = np.zeros(len(batch), bool)
    if len(filters) and len(batch):
        f = filters.iloc[0]
        hit = probe_filter(batch["key"].to_numpy(np.int64).view(np.uint64), int(f.seed), int(f.length), int(f.segments), f.slots)
    return batch[["digest", "min_id", "n"]].assign(maybe=hit)


def screen_batch(rows: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Distinct digests of a batch with ``maybe``: false says the snapshot lacks it for certain."""
    ship_code(rows.sparkSession)
    batch = _bucketed(_grouped(rows), snapshot.buckets)
    kind = dict(rows.dtypes)["doc_id"]
    return batch.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(
        _screen, f"digest string, min_id {kind}, n bigint, maybe boolean")


def merge_groups(rows: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Groups (digest, min_id, n) of snapshot and batch together."""
    screened = written(screen_batch(rows, snapshot), "screened")
    held = snapshot.digests.select("digest", "min_id", "n")
    positive = screened.filter("maybe").select("digest", F.col("min_id").alias("_m"), F.col("n").alias("_n"))
    both = held.join(positive, "digest", "full").select(
        "digest", F.least("min_id", "_m").alias("min_id"), (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"))
    return both.unionByName(screened.filter("NOT maybe").drop("maybe"))


def _texts_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Normalised texts of the given digest rows, fetched by (doc_id, raw hash): no hot key."""
    ids = rows.select(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw"), "digest").distinct()
    texts = docs.select("doc_id", "text", F.xxhash64(text_or_empty()).alias("raw"))
    return texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw"))).select(
        "doc_id", "raw", "digest", normalised().alias("text"))


def exact_dedup(docs: DataFrame, incoming: Column | None = None,
                digest: Callable[[Column], Column] = sha256, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, text_hash (of the text as it is).

    ``incoming`` marks the rows of the new batch; the others form the snapshot. By
    default half of the rows, by a hash of doc_id, play each part.
    """
    if incoming is None:
        incoming = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    docs = docs.select("doc_id", "text")
    rows = digest_rows(docs, digest)
    part = F.coalesce(incoming, F.lit(False))
    groups = written(merge_groups(rows.filter(part), build_snapshot(rows.filter(~part), bucket_rows)), "groups")
    # byte check: the texts of every row in a group of two or more, grouped by (digest, text)
    many = groups.filter("n > 1").select("digest")
    by_text = written(
        _texts_of(docs, rows.join(many, "digest", "left_semi")).groupBy("digest", "text").agg(
            F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "checked")
    per = by_text.groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    one = rows.join(per, "digest", "left")
    clash = per.filter("texts > 1").select("digest")
    if not clash.isEmpty():  # a digest that stands for several texts: the texts themselves tell its rows apart
        told = _texts_of(docs, rows.join(clash, "digest", "left_semi")).join(by_text, ["digest", "text"]).select(
            "doc_id", "raw", "digest", "keep_id", "group_size")
        told = rows.join(told.withColumnsRenamed({"doc_id": "_id", "raw": "_raw"}).distinct(), F.col("doc_id").eqNullSafe(
            F.col("_id")) & (F.col("raw") == F.col("_raw")), "inner").drop("_id", "_raw").drop(told["digest"])
        one = one.filter("texts IS NULL OR texts = 1").drop("texts").unionByName(told, allowMissingColumns=True)
    return one.select("doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
                      F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull() & F.col("doc_id").isNotNull()).alias("kept"),
                      F.col("digest" if digest is sha256 else "text_sha256").alias("text_sha256"), F.col("raw").alias("text_hash"))


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""

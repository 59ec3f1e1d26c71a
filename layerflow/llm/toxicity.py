"""Toxicity: a convolutional text classifier, trained in numpy on labelled rows.

A word's embedding is the sum of the rows that a hashed table has for the word
and for its first 5, 7 and 8 bytes, so that forms of one stem share rows; words and
stems of few training texts have none. Filters of widths 1, 2 and 3 run over the
whole text, each keeps its largest response (max pooling), and a linear
layer gives the logit. Every labelled row that is not held out counts: two thirds train, in shards
by a hash of doc_id that tasks hold one at a time, each going on from the net of the first shard,
and the shards' nets are averaged by their rows; on the other third, counted in bins of the logit, the threshold is
set: the logit halfway between the classes becomes score 0.5. Thresholds by language are set on the same rows and
returned beside the score (``lang_threshold``, ``flagged``); the score and
``predicted`` use the text alone.

Words are runs of ASCII letters (lower-cased) and non-ASCII bytes.

Defined results: a null or empty text is scored as a text of one padding word;
a language without enough labelled rows, or null, has threshold 0.5; without
labels of both classes every score is 0.0; rows that repeat are scored alike; of
labels that repeat a doc_id the largest counts, null labels do not; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.llm.common import discard, ship_code, text_or_empty, written
from layerflow.llm.tokens import chunks, letters_table, word_hashes

SHARD_ROWS = 6_000   # about the rows of a shard
DIMS, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
PREFIXES = (5, 7, 8)
EPOCHS, MORE_EPOCHS, RATE = 5, 2, 0.03  # of the first shard, and of every shard from its net
BIN = 0.001          # width of the bins of logits
FALSE_ALARM = 5      # a false alarm's weight when the threshold is set, beside 1 for a miss (both as shares of their class)
MIN_SHARE = 0.002    # a word or stem gets a row if this share of the training texts, and two of them, hold it
SLOT_BITS = 20       # slots of the hashed table; a slot belongs to the word or stem that most texts hold
GAP = max(WIDTHS) - 1


def features(data: np.ndarray, offsets: np.ndarray, table) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes (words x kinds, 0: none) of each word and its stems, and the words before each text."""
    hashes, before, *stems = word_hashes(data, offsets, table, PREFIXES)
    return np.stack([hashes, *stems], axis=1).astype(np.uint32), before


class Net:
    """Parameters, forward pass and training."""

    def __init__(self, keys: np.ndarray, seen: np.ndarray, seed: int = 11):
        """``keys``: ascending hashes of the words and stems that get rows; ``seen``: the training texts that hold each."""
        rng = np.random.default_rng(seed)
        order = np.argsort(seen, kind="stable")  # the most frequent is written last and keeps the slot
        self.prints = np.append(keys, np.uint32(0))
        self.slots = np.full(1 << SLOT_BITS, len(keys), np.int32)
        self.slots[keys[order] & np.uint32((1 << SLOT_BITS) - 1)] = order
        self.none = len(keys)  # the row of padding and of all that has none: zero
        self.table = rng.normal(0, 0.01, (len(keys) + 1, DIMS)).astype(np.float32)
        self.table[self.none] = 0
        self.conv = [rng.normal(0, 0.5, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.5, len(WIDTHS) * FILTERS).astype(np.float32)
        self.off = np.float32(-1.0)
        self.scale, self.shift = 1.0, 0.0
        self.by_lang: dict[str, float] = {}
        self.sums = [np.full_like(p, 1e-6) for p in self._arrays()]
        self.off_sum = 1e-6

    def _arrays(self) -> list[np.ndarray]:
        return [self.table, *self.conv, *self.bias, self.out]

    def packed(self) -> bytes:
        """All that training changes, as 32-bit numbers."""
        return np.concatenate([a.ravel() for a in (*self._arrays(), *self.sums, np.array([self.off, self.off_sum]))]).astype(np.float32).tobytes()

    def unpack(self, values: np.ndarray) -> Net:
        at = 0
        for a in (*self._arrays(), *self.sums):
            a[...] = values[at:at + a.size].reshape(a.shape)
            at += a.size
        self.off, self.off_sum = np.float32(values[at]), float(values[at + 1])
        return self

    def rows(self, hashed: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Table rows of every text's words, each text followed by padding for the widest filter; begin of each text."""
        row = self.slots[hashed & np.uint32((1 << SLOT_BITS) - 1)]
        row[self.prints[row] != hashed] = self.none
        words = np.diff(before)
        begin = np.concatenate([[0], np.cumsum(np.maximum(words, 1) + GAP)]).astype(np.int64)
        out = np.full((begin[-1], hashed.shape[1]), self.none, np.int32)
        out[np.arange(len(row)) + np.repeat(begin[:-1] - before[:-1], words)] = row
        return out, begin

    def embedded(self, rows: np.ndarray) -> np.ndarray:
        x = self.table[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            x = x + self.table[rows[:, k]]
        return x

    def responses(self, x: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
        """Responses of the filters of each width at every place, padded to one length."""
        out = []
        for w, conv in zip(WIDTHS, self.conv, strict=True):
            n = len(x) - w + 1
            z = x[:n] @ conv[0]
            for k in range(1, w):
                z += x[k:n + k] @ conv[k]
            out.append(np.concatenate([z, np.zeros((w - 1, FILTERS), np.float32)]))
        return out

    def pooled(self, rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
        # windows that begin in a text's padding are left out
        stops = np.stack([begin[:-1], begin[1:] - GAP], axis=1).ravel()
        return np.concatenate([np.maximum.reduceat(z, stops, axis=0)[0::2]
                               for z in self.responses(self.embedded(rows), begin)], axis=1)

    def logits(self, hashed: np.ndarray, before: np.ndarray) -> np.ndarray:
        return np.maximum(self.pooled(*self.rows(hashed, before)) + np.concatenate(self.bias), 0) @ self.out + self.off

    def scores(self, hashed: np.ndarray, before: np.ndarray) -> np.ndarray:
        z = (self.logits(hashed, before).astype(np.float64) - self.shift) * self.scale
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def train(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        sums = self.sums
        weight = np.where(labels > 0, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6)).astype(np.float32)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // 32)):
                before = np.concatenate([[0], np.cumsum([len(texts[k]) for k in part])])
                rows, begin = self.rows(np.concatenate([texts[k] for k in part]), before)
                x = self.embedded(rows)
                place = np.empty((len(part), len(self.out)), np.int64)
                pooled = np.empty(place.shape, np.float32)
                for j, z in enumerate(self.responses(x, begin)):
                    own = slice(j * FILTERS, (j + 1) * FILTERS)
                    for t in range(len(part)):
                        a, b = begin[t], begin[t + 1] - GAP
                        place[t, own] = a + z[a:b].argmax(axis=0)
                    pooled[:, own] = z[place[:, own], np.arange(FILTERS)]
                active = np.maximum(pooled + np.concatenate(self.bias), 0)
                p = 1 / (1 + np.exp(-np.clip(active @ self.out + self.off, -30, 30)))
                g = (p - labels[part]) * weight[part] / len(part)
                back = (g[:, None] * self.out) * (active > 0)
                self.out -= self._step(sums[-1], active.T @ g)
                self.off_sum += float(g.sum()) ** 2
                self.off -= np.float32(RATE * g.sum() / np.sqrt(self.off_sum))
                touched, grads = [], []
                for j, (w, conv) in enumerate(zip(WIDTHS, self.conv, strict=True)):
                    own = slice(j * FILTERS, (j + 1) * FILTERS)
                    at, d = place[:, own], back[:, own]
                    d_conv = np.zeros_like(conv)
                    for k in range(w):
                        d_conv[k] = np.einsum("tfd,tf->df", x[at + k], d)
                        touched.append(rows[at + k].reshape(-1, rows.shape[1]))
                        grads.append((d[:, :, None] * conv[k].T[None]).reshape(-1, DIMS))
                    conv -= self._step(sums[1 + j], d_conv)
                    self.bias[j] -= self._step(sums[1 + len(WIDTHS) + j], d.sum(axis=0))
                at = np.concatenate(touched)
                now, index = np.unique(at, return_inverse=True)
                total = np.zeros((len(now), DIMS), np.float32)
                np.add.at(total, index.reshape(at.shape), np.concatenate(grads)[:, None, :])
                total[now == self.none] = 0
                sums[0][now] += total ** 2
                self.table[now] -= RATE * total / np.sqrt(sums[0][now])

    @staticmethod
    def _step(total: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        total += gradient ** 2
        return (RATE * gradient / np.sqrt(total)).astype(np.float32)


def _threshold(z: np.ndarray, bad: np.ndarray, good: np.ndarray) -> float:
    """Cut with the least share of misses plus ``FALSE_ALARM`` times that of false alarms; of equal cuts the middle one.

    ``z``: ascending logits, ``bad`` and ``good``: the rows of each class there.
    """
    missed = np.concatenate([[0], np.cumsum(bad)]) / max(bad.sum(), 1)
    wrong = (good.sum() - np.concatenate([[0], np.cumsum(good)])) / max(good.sum(), 1)
    cost = missed + FALSE_ALARM * wrong
    best = np.flatnonzero(cost == cost.min())
    k = int(best[len(best) // 2])
    return float((z[max(k - 1, 0)] + z[min(k, len(z) - 1)]) / 2)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, text, toxic (0 or 1) of every labelled row that is not held out, and whether it is kept back for the threshold."""
    rows = labels.filter(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    # joined alike at every size: the labels grow with the texts, so they are not broadcast
    rows = docs.filter(~held_out()).select("doc_id", F.col("lang").cast("string"), text_or_empty().alias("text")).join(rows.hint("merge"), "doc_id")
    return written(rows.withColumn("back", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)) == 0), "toxicity-rows")


def _hashed(texts: pa.Array, table) -> Iterator[np.ndarray]:
    for _, _, data, at in chunks(texts):
        hashed, before = features(data, at, table)
        yield from (hashed[a:b] for a, b in zip(before[:-1], before[1:], strict=True))


def _vocabulary(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and stems that ``MIN_SHARE`` of the texts, and two of them, hold, with their texts: bounded by a text's words over the share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letters_table()
        for batch in batches:
            found = [np.unique(t) for t in _hashed(batch.column("text"), table)]
            keys, seen = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint32), np.zeros(0, int))
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(seen.astype(np.int64))], ["key", "n"])

    counted = rows.select("text").mapInArrow(run, "key long, n long").filter("key <> 0").groupBy("key").agg(F.sum("n").alias("n"))
    kept = sorted(tuple(r) for r in counted.filter(F.col("n") >= max(2, MIN_SHARE * n)).collect())
    return np.array([k for k, _ in kept], np.uint32), np.array([c for _, c in kept], np.int64)


def _trained(rows: DataFrame, net: Net, epochs: int) -> np.ndarray:
    """Parameters of ``net`` after each shard of ``rows`` has trained it by itself, averaged by the shards' rows."""
    start = rows.sparkSession.sparkContext.broadcast(net)

    def train(shard: pa.Table) -> pa.Table:
        order = np.lexsort((shard.column("toxic").to_numpy(), shard.column("h").to_numpy()))
        shard = shard.take(pa.array(order)).combine_chunks()
        own = copy.deepcopy(start.value)
        own.train(list(_hashed(shard.column("text"), letters_table())), shard.column("toxic").to_numpy().astype(np.float32), epochs)
        return pa.table({"shard": shard.column("shard").slice(0, 1), "n": pa.array([len(shard)], pa.int64()), "net": pa.array([own.packed()], pa.binary())})

    def mean(nets: pa.Table) -> pa.Table:
        nets = nets.sort_by("shard")
        n = nets.column("n").to_numpy().astype(np.float64)
        total = sum(w * np.frombuffer(v.as_py(), np.float32).astype(np.float64) for w, v in zip(n, nets.column("net"), strict=True))
        return pa.table({"shard": nets.column("shard").slice(0, 1), "n": pa.array([int(n.sum())], pa.int64()),
                         "net": pa.array([(total / n.sum()).astype(np.float32).tobytes()], pa.binary())})

    schema = "shard long, n long, net binary"
    nets = rows.select("shard", F.xxhash64("doc_id", "text").alias("h"), "toxic", "text").groupBy("shard").applyInArrow(train, schema)
    # averaged in about as many groups as each has shards, so that neither a task nor the driver holds them all
    groups = 1 + math.isqrt(rows.agg(F.max("shard")).first()[0] + 1)
    part = nets.withColumn("g", F.pmod("shard", F.lit(groups))).groupBy("g").applyInArrow(lambda t: mean(t.drop_columns(["g"])), schema).collect()
    return np.frombuffer(mean(pa.table({k: [r[k] for r in part] for k in ("shard", "n", "net")})).column("net")[0].as_py(), np.float32)


def _bins(rows: DataFrame, net: Net) -> list:
    """(lang, toxic, bin, n): rows by language, label and bin of the logit."""
    model = rows.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letters_table()
        for batch in batches:
            z = np.zeros(batch.num_rows)
            for a, b, data, at in chunks(batch.column("text")):
                z[a:b] = model.value.logits(*features(data, at, table))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("toxic"), pa.array(np.rint(np.clip(z, -100, 100) / BIN).astype(np.int64))],
                                             ["lang", "toxic", "bin"])

    return rows.select("lang", "toxic", "text").mapInArrow(run, "lang string, toxic int, bin long").groupBy("lang", "toxic", "bin").agg(
        F.count(F.lit(1)).alias("n")).collect()


def _classes(bins: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending logits and the toxic and other rows at each."""
    at, index = np.unique(np.array([r.bin for r in bins], np.int64), return_inverse=True)
    n, y = np.array([r.n for r in bins], float), np.array([r.toxic for r in bins])
    return at * BIN, np.bincount(index, n * (y == 1), len(at)), np.bincount(index, n * (y == 0), len(at))


def fit(docs: DataFrame, labels: DataFrame) -> Net | None:
    """Classifier from all labelled rows that are not held out; None without both classes."""
    ship_code(docs.sparkSession)
    rows = _labelled(docs, labels)
    seen = {(r.back, r.toxic): r["count"] for r in rows.groupBy("back", "toxic").count().collect()}
    if not all(seen.get((False, y), 0) + seen.get((True, y), 0) for y in (0, 1)):
        discard(rows)
        return None
    split = all(seen.get((back, y)) for back in (False, True) for y in (0, 1))  # else the few rows there are do both
    train, back = (rows.filter("NOT back"), rows.filter("back")) if split else (rows, rows)
    n = sum(c for (kept_back, _), c in seen.items() if not (split and kept_back))
    shards = -(-n // SHARD_ROWS)
    train = train.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(shards)))
    net = Net(*_vocabulary(train, n))
    first = train.agg(F.min("shard")).first()[0]
    net.unpack(_trained(train.filter(F.col("shard") == first), net, EPOCHS))
    if shards > 1:
        net.unpack(_trained(train, copy.deepcopy(net), MORE_EPOCHS))
    bins = _bins(back, net)
    discard(rows)
    z, bad, good = _classes(bins)
    net.shift = _threshold(z, bad, good)
    mean = np.average(z, weights=bad + good)
    net.scale = 4.0 / max(float(np.sqrt(np.average((z - mean) ** 2, weights=bad + good))), 1e-3)
    for lang in sorted({r.lang for r in bins} - {None, ""}):
        z, bad, good = _classes([r for r in bins if r.lang == lang])
        if bad.sum() >= 10 and good.sum() >= 10:
            net.by_lang[lang] = _threshold(1 / (1 + np.exp(-np.clip((z - net.shift) * net.scale, -30, 30))), bad, good)
    return net


def score(docs: DataFrame, net: Net | None) -> DataFrame:
    """doc_id, held_out, score, predicted, lang_threshold, flagged of every document."""
    ship_code(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    model = docs.sparkSession.sparkContext.broadcast(net)  # a few MB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, table = model.value, letters_table()
        for batch in batches:
            out = np.zeros(batch.num_rows)
            if net is not None:
                for a, b, data, at in chunks(batch.column("text")):
                    out[a:b] = net.scores(*features(data, at, table))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(out)], ["doc_id", "lang", "score"])

    scored = docs.select("doc_id", F.col("lang").cast("string"), text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang string, score double")
    cuts = F.lit(0.5)
    for lang, cut in sorted((net.by_lang if net else {}).items()):
        cuts = F.when(F.col("lang") == lang, F.lit(cut)).otherwise(cuts)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         cuts.alias("lang_threshold"), (F.col("score") >= cuts).alias("flagged"))

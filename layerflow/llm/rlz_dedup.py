"""Substring dedup by relative Lempel-Ziv parsing over words.

The reference is made of all documents, cut into blocks, and the index holds
for every distinct block the smallest document (and the place in it) that has
it. Cuts depend on content only: every window of ``WINDOW`` words names the
leftmost of its smallest ``GRAM``-word hashes, its anchor, and a block is a
stretch of windows with one anchor in common, about one for every
18 words. A document is parsed greedily from left to right: a factor starts at
the first block that the index gives to a smaller document, and goes on as long
as the next block stands next in that same document. A block is at least one
window, so every factor is long enough to be a duplicate span.

Cuts next to a place where two texts part differ, so windows that cross a
factor's boundary can be shared without their block being so. They are checked
one by one: equal windows have equal anchors, so only blocks whose anchor has
several different blocks, and which no smaller document has whole, can hold one.
One document for each such block lists its windows, the least document of every
window is counted, and windows that a smaller document has become spans too.

Everything is counted by (anchor, content) with minima that combine on the map
side, and what comes back is joined to written tables by sorting at every size, where
adaptive execution splits hot keys. Keys are two hashes of 64 bits.

Defined results: a null text has no words; texts under ``WINDOW`` words keep
all; rows that repeat a doc_id never lose a window to each other; a null doc_id
counts as the largest bigint, so its rows lose what any numbered row has, but nothing
to each other; an empty table gives an empty result. Other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerflow.llm import tokens
from layerflow.llm.common import discard, ship_code, written

WINDOW = 50
GRAM = 16
NO_ID = (1 << 63) - 1
SECOND = np.uint64(0x5851F42D4C957F2D)


def _table() -> tuple[np.ndarray, np.ndarray]:
    """Separators 0x20 and 0x09-0x0D; bytes as they are."""
    return tokens.spaces_table()[0], np.arange(256, dtype=np.uint8)


class Stretches:
    """Hashes of any stretch of a sequence of word hashes, from prefix sums."""

    def __init__(self, words: np.ndarray):
        self.power, self.inverse = tokens._powers(len(words) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.power[:len(words)])])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return tokens.mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every i the first place of the least of values[i:i + width], by doubling."""
    at, span = np.arange(len(values)), 1
    while span * 2 <= width:
        left, right = at[:len(at) - span], at[span:]
        at, span = np.where(values[left] <= values[right], left, right), span * 2
    left, right = at[:len(values) - width + 1], at[width - span:][:len(values) - width + 1]
    return np.where(values[left] <= values[right], left, right)


def cut(words: np.ndarray, before: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Blocks of texts laid end to end: (text, first window, number of windows, anchor hash, content hash)."""
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none, none, none, none, none
    starts = np.arange(len(words) - gram + 1)
    grams = Stretches(words).hash(starts, starts + gram)
    anchor = leftmost_least(grams, window - gram + 1)  # of the window that starts here
    text = np.searchsorted(before, np.arange(len(anchor)), side="right") - 1
    valid = np.flatnonzero(np.arange(len(anchor)) + window <= before[1:][text])
    if not len(valid):
        return none, none, none, none, none
    new = np.ones(len(valid), bool)
    new[1:] = (anchor[valid[1:]] != anchor[valid[:-1]]) | (text[valid[1:]] != text[valid[:-1]])
    first = np.flatnonzero(new)
    start, count = valid[first], np.diff(np.append(first, len(valid)))
    content = Stretches(tokens.mix(words ^ SECOND)).hash(start, start + count - 1 + window)
    return text[start], start - before[:-1][text[start]], count, grams[anchor[start]].view(np.int64), content.view(np.int64)


BLOCKS = "_rank bigint, _hash bigint, start int, n int, g bigint, h bigint"


def list_blocks(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in tokens.chunks(batch.column("_text")):
            words, before = tokens.word_hashes(data, offsets, _table())
            text, start, n, g, h = cut(words, before, window, gram)
            own = batch.slice(row, end - row)
            ids = [own.column(c).to_numpy()[text] for c in ("_rank", "_hash")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*ids, start.astype(np.int32), n.astype(np.int32), g, h)],
                                             names=["_rank", "_hash", "start", "n", "g", "h"])


def list_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(anchor, window hash, document, place) of all windows of the blocks named beside a text."""
    for batch in batches:
        blocks = batch.column("_blocks")
        for row, end, data, offsets in tokens.chunks(batch.column("_text")):
            words, before = tokens.word_hashes(data, offsets, _table())
            hashes = Stretches(tokens.mix(words ^ SECOND))
            mine = blocks.slice(row, end - row)
            each = mine.flatten()
            text = np.repeat(np.arange(end - row), mine.value_lengths().to_numpy())
            start, n, g = (each.field(c).to_numpy() for c in ("start", "n", "g"))
            block = np.repeat(np.arange(len(n)), n)
            place = start[block] + np.arange(len(block)) - np.repeat(np.cumsum(n) - n, n)
            at = before[:-1][text[block]] + place
            out = [g[block], hashes.hash(at, at + window).view(np.int64)]
            out += [batch.column(c).to_numpy()[row:end][text[block]] for c in ("_rank", "_hash")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*out, place.astype(np.int32))], names=["g", "w", "_rank", "_hash", "place"])


def factors(found: list[dict], window: int) -> list[tuple[int, int, int, int]]:
    """Greedy parse of one document's found blocks: (first word, end word, source rank, source word), in order."""
    out: list[tuple[int, int, int, int]] = []
    upto = -1  # windows before it are in a factor
    for b in sorted(found, key=lambda b: (b["start"], -b["n"])):
        if b["start"] + b["n"] <= upto:
            continue
        begin, stop, source = b["start"], b["start"] + b["n"], (b["s_rank"], b["s_start"] - b["start"])
        if out and begin <= upto and (out[-1][2], out[-1][3] - out[-1][0]) == source:  # stands next in the same place
            out[-1] = (out[-1][0], stop - 1 + window, *out[-1][2:])
        else:
            out.append((begin, stop - 1 + window, b["s_rank"], b["s_start"]))
        upto = stop
    return out


REMOVED = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, n_factors bigint"


def apply(batches: Iterator[pa.RecordBatch], window: int, keep_text: bool) -> Iterator[pa.RecordBatch]:
    """Words that no span covers, joined by a space."""
    for batch in batches:
        out: list[tuple] = []
        for doc_id, text, found in zip(*(batch.column(c) for c in ("doc_id", "_text", "_found"))):
            words = (text.as_py() or "").encode().split()  # bytes split at 0x20 and 0x09-0x0D
            gone, parsed = 0, []
            if found.is_valid:
                found = found.as_py()
                parsed = factors([b for b in found if b["s_rank"] is not None], window)
                spans = sorted([f[:2] for f in parsed] + [(b["start"], b["start"] + b["n"] - 1 + window) for b in found if b["s_rank"] is None])
                kept, at = [], 0
                for begin, end in spans:
                    kept += words[at:max(at, begin)]
                    at = max(at, end)
                kept += words[at:]
                gone, words, size = len(words) - len(kept), kept, len(words)
            joined = b" ".join(words)
            out.append((doc_id.as_py(), len(words) + gone, gone, hashlib.sha256(joined).hexdigest(), len(parsed), *([joined.decode()] if keep_text else [])))
        columns = list(zip(*out)) or [[]] * (5 + keep_text)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "n_factors", "kept_text"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names[:len(columns)])


def remove_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """One row per document: its words, how many are covered by windows that a smaller document has, and what is left.

    ``n_factors`` is the number of factors of its parse; with ``keep_text`` the kept words come too.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    ship_code(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").alias("_text"), F.coalesce("doc_id", F.lit(NO_ID)).alias("_rank"), F.xxhash64("text").alias("_hash"))
    blocks = written(rows.select("_text", "_rank", "_hash").mapInArrow(lambda b: list_blocks(b, window, gram), BLOCKS), "blocks")
    # anchors of more than one document; several: with more than one block
    shared = blocks.groupBy("g").agg(F.min("_rank").alias("lo"), F.max("_rank").alias("hi"), F.min("h").alias("h0"), F.max("h").alias("h1"))
    shared = written(shared.filter("lo < hi").select(F.col("g").alias("_g"), (F.col("h0") != F.col("h1")).alias("several")), "anchors")
    mine = written(blocks.join(shared.hint("merge"), F.col("g") == F.col("_g")).drop("_g"), "shared-blocks")
    discard(blocks, shared)
    index = mine.groupBy(F.col("g").alias("_g"), F.col("h").alias("_h")).agg(F.min(F.struct("_rank", "start")).alias("s"))
    index = written(index.select("_g", "_h", F.col("s._rank").alias("s_rank"), F.col("s.start").alias("s_start")), "index")
    placed = written(mine.join(index.hint("merge"), (F.col("g") == F.col("_g")) & (F.col("h") == F.col("_h"))).filter("s_rank < _rank OR several")
                     .select("_rank", "_hash", "start", "n", "g", "s_rank", "s_start"), "placed")
    discard(mine, index)

    key = ["_rank", "_hash"]
    edge = placed.filter("s_rank = _rank").groupBy(F.col("_rank").alias("_r"), F.col("_hash").alias("_t")).agg(F.collect_list(F.struct("start", "n", "g")).alias("_blocks"))
    at = rows.join(edge.hint("merge"), (F.col("_rank") == F.col("_r")) & (F.col("_hash") == F.col("_t")))
    windows = written(at.select("_text", *key, "_blocks").mapInArrow(lambda b: list_windows(b, window), "g bigint, w bigint, _rank bigint, _hash bigint, place int"), "windows")
    least = windows.groupBy(F.col("g").alias("_g"), F.col("w").alias("_w")).agg(F.min("_rank").alias("lo"), F.max("_rank").alias("hi")).filter("lo < hi")
    least = written(least.select("_g", "_w", "lo"), "least")
    late = windows.join(least.hint("merge"), (F.col("g") == F.col("_g")) & (F.col("w") == F.col("_w"))).filter("lo < _rank")
    late = late.select(*key, F.col("place").alias("start"), F.lit(1).alias("n"), F.lit(None).cast("bigint").alias("s_rank"), F.lit(None).cast("int").alias("s_start"))

    found = placed.filter("s_rank < _rank").select(*key, "start", "n", "s_rank", "s_start").unionByName(late)
    found = found.groupBy(*[F.col(c).alias(c + "f") for c in key]).agg(F.collect_set(F.struct("start", "n", "s_rank", "s_start")).alias("_found"))
    out = rows.join(found.hint("merge"), (F.col("_rank") == F.col("_rankf")) & (F.col("_hash") == F.col("_hashf")), "left")
    schema = REMOVED + (", kept_text string" if keep_text else "")
    return out.select("doc_id", "_text", "_found").mapInArrow(lambda b: apply(b, window, keep_text), schema)


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
runs AS (
  SELECT r, coalesce(doc_id, 9223372036854775807) AS k, p, array_to_string(list_slice(w, p, p + 49), ' ') AS s
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
lost AS (
  SELECT a.r, list(a.p) AS ps FROM (SELECT r, p, k, min(k) OVER (PARTITION BY s) AS lo FROM runs) a WHERE a.lo < a.k GROUP BY a.r),
gone AS (
  SELECT r, list_distinct(flatten(list_transform(ps, lambda p: range(p, p + 50)))) AS g FROM lost)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(len(g.g), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN g.g IS NULL THEN array_to_string(d.w, ' ')
    ELSE array_to_string(list_transform(list_sort(list_filter(range(1, len(d.w) + 1), lambda i: NOT list_contains(g.g, i))), lambda i: d.w[i]), ' ') END) AS kept_sha256
FROM d LEFT JOIN gone g USING (r)
"""

"""Repeated passages: every byte of a string of ``length`` bytes that starts anywhere else is removed.

Not every suffix is sorted, only those that start at anchors. Of the windows of
``length`` bytes each has one anchor, the place in it where the hash of the next
length / 2 bytes is smallest (the leftmost of equals); equal windows have their anchor
at the same place, so it is enough to compare suffixes whose anchors begin with the same
bytes. The windows of one anchor cover a unit: the anchor, what is left of it, what
is right of it. Units that are equal in full are counted, copies first on the map side;
all of their bytes repeat. For a unit that occurs once but shares its anchor bytes with others,
the suffixes at the anchors are sorted by deep-shallow sorting (multikey
quicksort on the first bytes, then a blind trie for each group that is still equal), the
reversed left parts likewise; common prefixes of neighbours in both orders give
the windows that occur in another unit.

An anchor shared by more than ``hot_units`` different units is not sorted in one task: each
of its windows becomes a row, dealt and counted by the window's 128-bit hash.

A row is known by a 64-bit hash of doc_id and text. Everything is judged on the input texts.

Defined results: a null text counts as empty; texts shorter than ``length`` keep all bytes; rows that
repeat count as other places, so both lose what they share; a null doc_id is like any other;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.llm.common import discard, ship_code, text_or_empty, written
from layerflow.llm.tokens import BYTE_VALUES, _powers, buffers, mix

LENGTH = 400
HOT_UNITS = 50_000   # different units of one anchor that one task sorts
SHALLOW = 12         # bytes that multikey quicksort looks at before a blind trie takes over
PLACE_BITS = 24      # texts are searched in pieces that these bits can number


# ---------------------------------------------------------------- anchors

def _sums(data: np.ndarray) -> np.ndarray:
    power, _ = _powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(BYTE_VALUES[data] * power[:len(data)], out=out[1:])
    return out


def _hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = _powers(len(sums))
    with np.errstate(over="ignore"):
        return mix((sums[end] - sums[start]) * inverse[start])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor, first and last window start, hash of the anchor's bytes, hash of the unit, for each anchor of a text."""
    gram = length // 2
    reach = length - gram + 1  # places in a window where its anchor may be
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    limit = (1 << PLACE_BITS) - 2 * length
    parts = []
    for begin in range(0, n, limit):  # one piece but for texts of many MB
        piece = data[begin:begin + limit + length - 1]
        sums = _sums(piece)
        places = np.arange(len(piece) - gram + 1)
        grams = _hash(sums, places, places + gram)
        # smallest hash, then leftmost place, as one number
        least = (grams >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | places.astype(np.uint64)
        span = 1
        while span * 2 <= reach:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        windows = len(piece) - length + 1
        least = np.minimum(least[:windows], least[reach - span:reach - span + windows])
        at = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([first[1:], [windows]]) - 1
        at = at[first]
        with np.errstate(over="ignore"):
            unit = mix(_hash(sums, first, last + length) + ((at - first) << 20 | (last - first)).astype(np.uint64))
        parts.append((at + begin, first + begin, last + begin, grams[at].view(np.int64), unit.view(np.int64)))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def row_key() -> Column:
    return F.xxhash64("doc_id", text_or_empty())


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    data, at = buffers(column)
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield data[a:b]


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """gram, unit, key, at, back (from the first window to the anchor), span (bytes of the unit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gram", "unit", "key", "at", "back", "span"]
        for batch in batches:
            rows, held = [], 0
            for key, data in zip(batch.column("key").to_numpy(), _texts(batch.column("text")), strict=True):
                at, first, last, gram, unit = anchors(data, length)
                rows.append((gram, unit, np.full(len(at), key, np.int64), at, at - first, last + length - first))
                held += len(at)
                if held > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names)

    return docs.mapInArrow(run, "gram bigint, unit bigint, key bigint, at bigint, back bigint, span bigint")


# ---------------------------------------------------------------- deep-shallow sorting

def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix; the first ``start`` bytes are known to agree."""
    low, high = start, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:  # a[:low] == b[:low], a[:high] != b[:high]
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class BlindTrie:
    """Strings of a group by the bytes at which they branch only; a text is looked at once for each insertion."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.root: list | int | None = None  # a number of a text, or [depth, {byte or -1: child}]

    def insert(self, number: int) -> None:
        text = self.texts[number]
        if self.root is None:
            self.root = number
            return
        node = self.root
        while not isinstance(node, int):  # blind: bytes between the branches are not compared
            depth, children = node
            node = children.get(text[depth] if depth < len(text) else -1)
            if node is None:
                node = next(iter(children.values()))
        shared = common(text, self.texts[node])
        own = text[shared] if shared < len(text) else -1
        other = self.texts[node][shared] if shared < len(self.texts[node]) else -1
        parent, edge, node = None, -1, self.root
        while not isinstance(node, int) and node[0] < shared:
            parent, edge = node, text[node[0]]
            node = node[1][edge]
        if not isinstance(node, int) and node[0] == shared:
            node[1][own if own != other else -2 - number] = number  # the same text again gets a branch of its own
            return
        if own == other:
            children = {-1: node, -2 - number: number}
        else:
            children = {other: node, own: number}
        new = [shared, children]
        if parent is None:
            self.root = new
        else:
            parent[1][edge] = new

    def order(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, int):
                out.append(node)
            elif node is not None:
                stack.extend(child for _, child in sorted(node[1].items(), key=lambda x: x[0], reverse=True))
        return out


def deep_shallow(texts: list[bytes], start: int = 0, shallow: int = SHALLOW) -> list[int]:
    """Numbers of the texts in sorted order; the first ``start`` bytes agree."""
    out: list[int] = []
    stack = [(list(range(len(texts))), start)]
    while stack:  # multikey quicksort: smaller, equal, larger on one byte, in this order
        group, depth = stack.pop()
        if len(group) < 2:
            out.extend(group)
        elif depth - start >= shallow:
            trie = BlindTrie(texts)
            for number in group:
                trie.insert(number)
            out.extend(trie.order())
        else:
            byte = {k: texts[k][depth] if depth < len(texts[k]) else -1 for k in group}
            pivot = byte[group[len(group) // 2]]
            same = [k for k in group if byte[k] == pivot]
            stack.append(([k for k in group if byte[k] > pivot], depth))
            if pivot < 0:  # all ended here: equal
                stack.append((same, start + shallow))
            else:
                stack.append((same, depth + 1))
            stack.append(([k for k in group if byte[k] < pivot], depth))
    return out


def repeated(lefts: list[bytes], rights: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each unit of one anchor, ranges of window offsets (from the window's start to the anchor) found in another unit.

    ``lefts`` are reversed. All rights agree in the anchor's length // 2 bytes.
    """
    gram = length // 2
    order = deep_shallow(rights, gram)
    near = [common(rights[a], rights[b], gram) for a, b in zip(order, order[1:])]
    rank = [0] * len(lefts)
    for place, k in enumerate(deep_shallow(lefts)):
        rank[k] = place
    found: list[list[tuple[int, int]]] = [[] for _ in lefts]
    stack = [(0, len(order))]
    while stack:  # the groups that share ever longer right parts
        a, b = stack.pop()
        if b - a < 2:
            continue
        shared = min(near[a:b - 1])
        members = sorted(order[a:b], key=rank.__getitem__)
        left = [common(lefts[x], lefts[y]) for x, y in zip(members, members[1:])]
        for k, x in enumerate(members):
            most = max(left[k - 1] if k else 0, left[k] if k < len(left) else 0)
            if most >= length - shared:
                found[x].append((max(0, length - shared), most))
        cut = a
        for k in range(a, b - 1):
            if near[k] == shared:
                stack.append((cut, k + 1))
                cut = k + 1
        if cut > a:
            stack.append((cut, b))
    return found


# ---------------------------------------------------------------- the operator

def _unit_bytes(docs: DataFrame, units: DataFrame) -> DataFrame:
    """gram, unit, key, at, back, copies and the unit's bytes, for the given units."""
    asked = units.groupBy("key").agg(F.collect_list(F.struct("gram", "unit", "at", "back", "span", "copies")).alias("units"))
    joined = docs.join(asked.hint("merge"), "key")  # alike at every size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, key, own in zip(_texts(batch.column("text")), batch.column("key").to_pylist(), batch.column("units").to_pylist(), strict=True):
                for u in own:
                    begin = u["at"] - u["back"]
                    rows.append((u["gram"], u["unit"], key, u["at"], u["back"], u["copies"], data[begin:begin + u["span"]].tobytes()))
                if len(rows) > 20_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          ["gram", "unit", "key", "at", "back", "copies", "bytes"])

    return joined.select("key", "text", "units").mapInArrow(
        run, "gram bigint, unit bigint, key bigint, at bigint, back bigint, copies bigint, bytes binary")


def _sorted_groups(units: DataFrame, length: int) -> DataFrame:
    """key, start, end of the windows of single units that occur in another unit of their anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def settle(rows: list[tuple]) -> list[tuple[int, int, int]]:
            spans = []
            backs = [r[3] for r in rows]
            lefts = [r[5][:back][::-1] for r, back in zip(rows, backs, strict=True)]
            rights = [r[5][back:] for r, back in zip(rows, backs, strict=True)]
            for (_, key, at, back, copies, raw), ranges in zip(rows, repeated(lefts, rights, length), strict=True):
                if copies == 1:
                    least = back - (len(raw) - length)  # offset of the unit's last window
                    for low, high in ranges:
                        low, high = max(low, least), min(high, back)
                        if low <= high:
                            spans.append((key, at - high, at - low + length))
            return spans

        group: list[tuple] = []
        for batch in batches:
            spans: list[tuple[int, int, int]] = []
            for row in zip(batch["gram"], batch["key"], batch["at"], batch["back"], batch["copies"], batch["bytes"], strict=True):
                if group and group[0][0] != row[0]:
                    spans.extend(settle(group))
                    group = []
                group.append(row)
            if spans:
                yield pd.DataFrame(spans, columns=["key", "start", "end"])
        if group and (spans := settle(group)):
            yield pd.DataFrame(spans, columns=["key", "start", "end"])

    rows = units.select("gram", "key", "at", "back", "copies", "bytes").repartition("gram").sortWithinPartitions("gram", "key", "at")
    return rows.mapInPandas(run, "key bigint, start bigint, end bigint")


def _window_groups(units: DataFrame, length: int) -> DataFrame:
    """The same for hot anchors: every window is a row, counted by its hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                data = np.frombuffer(row.bytes, np.uint8)
                place = np.arange(len(data) - length + 1)
                one = _hash(_sums(data), place, place + length)
                two = _hash(_sums(data ^ np.uint8(0x5A)), place, place + length)
                yield pd.DataFrame({"one": one.view(np.int64), "two": two.view(np.int64), "key": row.key,
                                    "start": row.at - row.back + place, "single": row.copies == 1})

    windows = units.select("key", "at", "back", "copies", "bytes").mapInPandas(
        run, "one bigint, two bigint, key bigint, start bigint, single boolean")
    many = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("one", "two")
    return windows.filter("single").join(many, ["one", "two"], "left_semi").select("key", "start", (F.col("start") + length).alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot_units: int = HOT_UNITS, used: list[DataFrame] | None = None) -> DataFrame:
    """key, start, end (bytes) of everything to be removed; spans may overlap. ``docs`` has key and text.

    The written tables that the result is read from are added to ``used``, if given.
    """
    rows = written(_anchors(docs, length), "anchors")
    # two passes over narrow rows: which anchors occur twice, then the rows that have one of these
    shared = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("unit").alias("lo"), F.max("unit").alias("hi")).filter("n > 1")
    found = written(rows.join(shared.select("gram", (F.col("lo") != F.col("hi")).alias("mixed")), "gram"), "shared")
    discard(rows)
    span = [(F.col("at") - F.col("back")).alias("start"), (F.col("at") - F.col("back") + F.col("span")).alias("end")]
    alike = found.filter("NOT mixed").select("key", *span)
    mixed = found.filter("mixed")
    units = written(mixed.groupBy("gram", "unit").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "at", "back", "span")).alias("one")).select(
        "gram", "unit", "copies", "one.*"), "units")
    copied = mixed.join(units.filter("copies > 1").select("gram", "unit"), ["gram", "unit"], "left_semi").select("key", *span)
    of_gram = units.groupBy("gram").agg(F.count(F.lit(1)).alias("units"), F.min("copies").alias("least"))
    # where every unit has a copy nothing is left to sort
    held = written(_unit_bytes(docs, units.join(of_gram.filter("least = 1").select("gram"), "gram", "left_semi")), "unit-bytes")
    hot = of_gram.filter(F.col("units") > hot_units).select("gram")
    if used is not None:
        used += [found, units, held]
    spans = alike.unionByName(copied)
    if hot.isEmpty():
        spans = spans.unionByName(_sorted_groups(held, length))
    else:
        spans = spans.unionByName(_sorted_groups(held.join(hot, "gram", "left_anti"), length)).unionByName(
            _window_groups(held.join(hot, "gram", "left_semi"), length))
    return spans


def _runs(spans: list, n: int) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot_units: int = HOT_UNITS, keep_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes of every row."""
    ship_code(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    docs = docs.select("doc_id", text_or_empty().alias("text"), row_key().alias("key"))
    used: list[DataFrame] = []
    spans = repeated_spans(docs.select("key", "text"), length, hot_units, used)
    per_row = written(spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    discard(*used)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, spans in zip(_texts(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
                runs = _runs(spans, len(data))
                edges = [0, *[e for r in runs for e in r], len(data)]
                kept = b"".join(data[a:b].tobytes() for a, b in zip(edges[0::2], edges[1::2], strict=True))
                rows.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            size, removed, runs, digest, kept = zip(*rows, strict=True) if rows else ([],) * 5
            columns = [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_bytes:
                columns.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    joined = docs.join(per_row.hint("merge"), "key", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
                             + (", kept binary" if keep_bytes else ""))

"""Exact Jaccard self-join of word shingles by PartEnum signatures, and its components.

Sets are dealt into size bands whose ends differ by the similarity's ratio, so
linked sets lie in one band or in neighbours; a set takes part in its own
band's group and the next. In a group, linked sets differ in at most k elements.
The feature domain is cut into k // 2 + 1 (and some spare) parts, so one part at
least differs in one element or none; each part is cut again into two or
three cells, and the subsets that leave out one cell are enumerated: one of
these agrees in full. A signature is the hash of what a set has in such a subset.
Subsets in which a set has nothing are passed over while no more parts have one
than there are spare parts: an agreeing part that is not empty remains then.

Equal sets are one node. In each signature's bucket the members are compared with one of
them first, the centre (a star): the one that shares the most buckets, which
lies in the middle of a family. Whole sets are compared only if their marks allow a link: a mark is
the parity of the number of elements in each of some cells, about two for each element, and |x ^ y| is at least
the number of cells in which x and y differ. In buckets of at most ``LISTED`` members that are still in more than one component,
the marks of members of different components are compared in the bucket's task, and only pairs that these let pass leave it.
Buckets of at most ``PAIRS_PER_ROW`` times ``MARKS_PER_PAIR`` members are cut into blocks of about ``BLOCK``, and a task compares the marks of two blocks.

Larger buckets are never listed; they are settled in turns. Let c be a centre and d(x) what x
adds to c or lacks of it, |d(x)| elements. For linked x and y, d(x) and d(y) share (|d(x)| + |d(y)| - |x ^ y|) / 2
elements, and |x ^ y| is at most q (|x| + |y|), q = (100 - percent) / (100 + percent). If x and y are in different
components yet, one of them, x say, is outside c's, so |d(x)| > q (|x| + |c|), and they share
more than (|d(y)| - q (|y| - |c|)) / 2 elements and at least (|d(x)| - q (|x| + |c|)) / (1 + q).
So x and y share one of the first few elements of each, in any order common to all (a prefix
filter); here those come first that the fewest outside members have, and elements that none of these has are
not dealt at all. Buckets by centre and element that can be listed are listed as above, larger ones are the next turn's; those whose
members are in one component already are left out. It ends when no bucket is left, and loses no link between components.
Every compared pair is checked on whole sets.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased. Shingles are 64-bit hashes.

Defined results: a text without words (null, empty) has 0 shingles and is its own
component; a text with fewer words than a shingle has one shingle, its whole
sequence; repeated rows share a component; a null doc_id belongs to its set's
component without naming it (component_id null if no other member has an id); an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerflow.llm.common import discard, ship_code, small, text_or_empty, written
from layerflow.llm.components import components
from layerflow.llm.tokens import chunks, mix, spaces_table, windows, word_hashes

WIDE_K = 24                  # from this many differences on, parts have two cells instead of three

PAIRS_PER_ROW = 10           # pairs left for each row of the buckets, up to which they are compared one by one
LISTED = 1000                # members of a bucket whose marks are compared pair by pair
BLOCK = 4000                 # members of a block of a larger bucket, about
MARKS_PER_PAIR = 5000        # comparisons of marks that take the time of a comparison of whole sets
SLICES = 4                   # parts of the signatures, at most, that are dealt one after the other
SLICE_ROWS = 5_000_000       # signatures up to which one more part is not worth its jobs


class Bands:
    """Size bands and their signature layout for a similarity of ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low, self.high = [1], [max(1, 100 // percent)]

    def _reach(self, size: int) -> None:
        while self.high[-1] < size:
            self.low.append(self.high[-1] + 1)
            self.high.append(max(self.low[-1], self.low[-1] * 100 // self.percent))

    def most(self, a: int, b: int) -> int:
        """Differences that linked sets of these sizes have at most."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def of(self, size: int) -> int:
        self._reach(size)
        return int(np.searchsorted(self.high, size))

    def layout(self, group: int) -> tuple[int, int, int]:
        """(parts, cells of a part, spare parts) of a group; no parts where linked sets are equal."""
        while len(self.high) <= group:
            self._reach(self.high[-1] + 1)
        k = self.most(self.high[group], self.high[group])
        if k == 0:
            return 0, 0, 0
        cells = 2 if k >= WIDE_K else 3
        parts = k // 2 + 1
        each = self.low[max(group - 1, 0)] * (1 if cells == 2 else 2) / cells / parts  # elements of a subset, about
        spare = 1 + int(2 * parts * cells * np.exp(-each))
        return parts + spare, cells, spare


def signatures(sorted_set: np.ndarray, bands: Bands) -> np.ndarray:
    """Signatures of a set of 64-bit elements in its two groups."""
    out = []
    size = len(sorted_set)
    weight = mix(sorted_set)
    band = bands.of(size)
    for group in (band, band + 1):
        parts, cells, spare = bands.layout(group)
        if not parts:
            continue
        part = ((sorted_set >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cell = ((sorted_set & np.uint64(0xFFFFFFFF)) * np.uint64(cells)) >> np.uint64(32)
        at = (part * np.uint64(cells) + cell).astype(np.int64)
        sums = np.zeros(parts * cells, np.uint64)
        with np.errstate(over="ignore"):
            np.add.at(sums, at, weight)
            count = np.bincount(at, minlength=parts * cells).reshape(parts, cells)
            sums = sums.reshape(parts, cells)
            # leaving out one cell
            sums, count = sums.sum(axis=1, dtype=np.uint64)[:, None] - sums, count.sum(axis=1)[:, None] - count
            names = mix(np.arange(parts * cells, dtype=np.uint64) + np.uint64(group << 32)).reshape(parts, cells)
            values = mix(sums + names)
        filled = count > 0
        out.append(values.ravel() if (~filled).any(axis=1).sum() > spare else values[filled])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def mark(sorted_set: np.ndarray) -> np.ndarray:
    """Parities of the elements' number in a power of two of cells, three for two elements or more, as words of 64 bits."""
    cells = 64
    while 2 * cells < 3 * len(sorted_set):
        cells *= 2
    at = (mix(sorted_set) >> np.uint64(8)) & np.uint64(cells - 1)
    odd = np.bincount(at.astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _folded(marks: np.ndarray, words: int) -> np.ndarray:
    """Marks (one in a row) on fewer cells."""
    while marks.shape[1] > words:
        half = marks.shape[1] // 2
        marks = marks[:, :half] ^ marks[:, half:]
    return marks


def _near(a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of the members of different labels that may be linked, for (sizes, marks of one width, labels)."""
    (m, one, p), (n, two, q) = a, b
    half = (one.shape[1] + 1) // 2
    # most pairs are told apart by half of their cells
    least = np.zeros((len(m), len(n)), np.int32)
    for w in range(half):
        least += np.bitwise_count(one[:, w, None] ^ two[None, :, w])
    i, j = np.nonzero((least * (100 + percent) <= (100 - percent) * (m[:, None] + n[None, :])) & (p[:, None] != q[None, :]))
    least = least[i, j] + np.bitwise_count(one[i, half:] ^ two[j, half:]).sum(axis=1, dtype=np.int64)
    may = least * (100 + percent) <= (100 - percent) * (m[i] + n[j])
    return i[may], j[may]


def passing(sizes: np.ndarray, marks: list[np.ndarray], labels: np.ndarray, percent: int, second: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of members of different labels that may be linked by their sizes and marks: all, or those of a member outside and one in ``second``."""
    out = []
    words = np.array([len(m) for m in marks])
    side = np.zeros(len(marks), bool) if second is None else second
    stacked = {(w, s): (at := np.flatnonzero((words == w) & (side == s)), np.stack([marks[k] for k in at]))
               for w, s in sorted({(int(w), bool(s)) for w, s in zip(words, side, strict=True)})}
    for (v, s), (own, left) in stacked.items():
        for (w, t), (other, right) in stacked.items():
            if (s or not t) if second is not None else v > w:
                continue
            one, two = _folded(left, min(v, w)), np.asfortranarray(_folded(right, min(v, w)))
            step = max(1, (1 << 18) // len(other))
            for a in range(0, len(own), step):
                some = own[a:a + step]
                far = a if second is None and v == w else 0  # of one group, those before are compared already
                i, j = _near((sizes[some], one[a:a + step], labels[some]), (sizes[other[far:]], two[far:], labels[other[far:]]), percent)
                if second is None and v == w:
                    i, j = i[i < j], j[i < j]
                out += zip(some[i].tolist(), other[far:][j].tolist(), strict=True)
    return out


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a column."""
    table = spaces_table()
    for _, _, data, at in chunks(column):
        hashes, before = word_hashes(data, at, table)
        shingles, ahead = windows(hashes, before, words)
        for a, b in zip(ahead[:-1], ahead[1:], strict=True):
            yield np.unique(shingles[a:b])


def _node(sorted_set: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(mix(sorted_set).sum(dtype=np.uint64) + np.uint64(len(sorted_set))).view(np.int64))


def _sketches(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, node (hash of the set; null without shingles), its signatures and its mark.

    Of equal sets in one task the first alone carries signatures and mark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for batch in batches:
            size, node, found, marks = [], [], [], []
            for one in shingle_sets(batch.column("text"), words):
                size.append(len(one))
                key = _node(one) if len(one) else None
                node.append(key)
                new = key is not None and key not in seen
                found.append(signatures(one, bands).view(np.int64) if new else None)
                marks.append(mark(one).tobytes() if new else None)
                if new:
                    seen.add(key)
            flat = np.concatenate([np.zeros(0, np.int64), *[f for f in found if f is not None]])
            ends = np.concatenate([[0], np.cumsum([0 if f is None else len(f) for f in found])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(size, pa.int64()), pa.array(node, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), pa.array(marks, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "node", "signatures", "mark"])

    kind = dict(docs.dtypes)["doc_id"]
    return written(docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("text_hash")).mapInArrow(
        run, f"doc_id {kind}, text_hash bigint, n_shingles bigint, node bigint, signatures array<bigint>, mark binary"), "sketches")


def _marks(whole: DataFrame, shared: DataFrame) -> DataFrame:
    """node, its size and mark, and the row that stands for it (_id, _hash), for the nodes in a shared bucket."""
    # named by doc_id and text: rows without a doc_id share its null, and nodes of such rows alone have a set too
    row = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "text_hash", "n_shingles", "mark")).alias("row")
    one = whole.filter(F.col("mark").isNotNull()).groupBy("node").agg(row).join(shared.select("node").distinct(), "node", "left_semi")
    return written(one.select("node", F.col("row.n_shingles").alias("size"), "row.mark",
                              F.col("row.doc_id").alias("_id"), F.col("row.text_hash").alias("_hash")), "marks")


def _sets(docs: DataFrame, marks: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node and its shingles (binary, sorted uint64), for the given nodes: from the text of one row of each."""
    one = written(marks.select("node", "_id", "_hash").join(nodes, "node", "left_semi"), "representatives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), words))
            own = [_node(s) if len(s) else 0 for s in sets]
            asked = batch.column("node").to_pylist()
            # texts may share a doc_id and a hash: the one with this node's set counts
            keep = [k for k, (a, b) in enumerate(zip(own, asked, strict=True)) if a == b]
            yield pa.RecordBatch.from_arrays(
                [pa.array([asked[k] for k in keep], pa.int64()), pa.array([sets[k].tobytes() for k in keep], pa.binary())],
                ["node", "shingles"])

    texts = docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("text_hash"))
    asked = texts.join(small(one, 24), texts["doc_id"].eqNullSafe(one["_id"]) & (texts["text_hash"] == one["_hash"])).select("node", "text")
    return written(asked.mapInArrow(run, "node bigint, shingles binary").dropDuplicates(["node"]), "sets")


def _shared(rows: DataFrame, slices: int) -> tuple[DataFrame, list[DataFrame]]:
    """Of buckets (key, node), those with two different nodes or more, and the written tables that hold them:
    the keys are dealt in slices, one after the other."""
    group = Window.partitionBy("key")
    parts = []
    for k in range(slices):
        some = rows.filter(F.pmod("key", F.lit(slices)) == k)
        both = some.withColumn("lo", F.min("node").over(group)).withColumn("hi", F.max("node").over(group))
        # a node is in a bucket once for each task that saw it
        parts.append(written(both.filter("lo <> hi").select("key", "node").distinct(), "slice"))
    return reduce(DataFrame.unionByName, parts), parts


def _stars(shared: DataFrame) -> DataFrame:
    """centre, node and n, the buckets (key, node) that have them: of each bucket the node of the most buckets, and each other one."""
    weights = written(shared.groupBy("node").agg(F.count(F.lit(1)).alias("weight")), "weights")
    best = shared.join(small(weights, 16), "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("best"))
    rows = shared.join(best.select("key", F.col("best.node").alias("centre")), "key").filter("centre <> node")
    return rows.groupBy("centre", "node").agg(F.count(F.lit(1)).alias("n"))


def _compared(edges: DataFrame, sets: DataFrame, percent: int, apart: bool = False) -> DataFrame:
    """centre, node and linked; if asked for, also the elements in which they differ (tokens), and of how many of them one at least
    is shared with whatever set the node is linked to: if the node is outside the centre's component (outer), or if that set is (inner)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, tokens, outer, inner = [], [], [], []
            for one, two in zip(batch.column("left"), batch.column("right"), strict=True):
                c, x = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                differ = np.setxor1d(c, x, assume_unique=True)
                tokens.append(differ.view(np.int64) if apart else None)
                differ, both = len(differ), len(c) + len(x)
                common = (both - differ) // 2
                linked.append(100 * common >= percent * (differ + common))
                beyond = (100 + percent) * differ - (100 - percent) * both
                outer.append(differ - max(1, -(-beyond // 200)) + 1)
                least = ((100 + percent) * differ - (100 - percent) * (len(x) - len(c))) // (2 * (100 + percent)) + 1
                inner.append(differ - max(1, least) + 1)
            columns = [batch.column("centre"), batch.column("node"), pa.array(linked, pa.bool_())]
            names = ["centre", "node", "linked"]
            if apart:
                columns += [pa.array(tokens, pa.list_(pa.int64())), pa.array(outer, pa.int32()), pa.array(inner, pa.int32())]
                names += ["tokens", "outer", "inner"]
            yield pa.RecordBatch.from_arrays(columns, names)

    left = sets.select(F.col("node").alias("centre"), F.col("shingles").alias("left"))
    right = sets.select("node", F.col("shingles").alias("right"))
    return written(edges.select("centre", "node").join(left, "centre").join(right, "node").mapInArrow(
        run, "centre bigint, node bigint, linked boolean" + (", tokens array<bigint>, outer int, inner int" if apart else "")), "compared")


def _screened(edges: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The edges whose ends may be linked by their sizes and marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b, one, two in zip(*(batch.column(c).to_pylist() for c in ("_a", "_b", "_one", "_two")), strict=True):
                c, x = np.frombuffer(one, np.uint64)[None, :], np.frombuffer(two, np.uint64)[None, :]
                words = min(c.shape[1], x.shape[1])
                least = int(np.bitwise_count(_folded(c, words) ^ _folded(x, words)).sum())
                keep.append(least * (100 + percent) <= (100 - percent) * (a + b))
            yield batch.filter(pa.array(keep, pa.bool_())).select(names)

    names = edges.columns
    left = marks.select(F.col("node").alias("centre"), F.col("size").alias("_a"), F.col("mark").alias("_one"))
    right = marks.select("node", F.col("size").alias("_b"), F.col("mark").alias("_two"))
    return written(edges.join(left, "centre").join(right, "node").mapInArrow(run, edges.schema), "screened")


def _pairs(node: np.ndarray, found: list[tuple[int, int]]) -> set[tuple[int, int]]:
    return {(min(a, b), max(a, b)) for a, b in ((int(node[i]), int(node[j])) for i, j in found)}


def _pair_batch(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
    rows = sorted(pairs)
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in rows], pa.int64()), pa.array([p[1] for p in rows], pa.int64())], ["centre", "node"])


def _passing(listed: DataFrame, blocked: DataFrame | None, marks: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (centre, node) of different labels in a bucket that may be linked. Each pair of blocks of a ``blocked`` bucket
    (key, node, label, n) is a group, so no task holds more than two blocks, and a large bucket is many tasks' work."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[int, int]] = set()
            column = batch.column("members")
            ends, rows = column.offsets.to_numpy(), column.values
            node, label, size = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("node", "label", "size"))
            each = [np.frombuffer(m.as_buffer(), np.uint64) for m in rows.field("mark")]
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                found |= _pairs(node[a:b], passing(size[a:b], each[a:b], label[a:b], percent))
            yield _pair_batch(found)

    def run_blocks(group: pa.Table) -> pa.Table:
        node, label, size, block = (group.column(c).to_numpy() for c in ("node", "label", "size", "block"))
        each = [np.frombuffer(m.as_buffer(), np.uint64) for m in group.column("mark")]
        second = block == group.column("j")[0].as_py() if group.column("i")[0] != group.column("j")[0] else None
        return pa.Table.from_batches([_pair_batch(_pairs(node, passing(size, each, label, percent, second)))])

    told = marks.select("node", F.col("size").cast("bigint").alias("size"), "mark")
    members = listed.join(told, "node").groupBy("key").agg(F.collect_list(F.struct("node", "label", "size", "mark")).alias("members"))
    pairs = members.select("members").mapInArrow(run, "centre bigint, node bigint")
    if blocked is not None:
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        dealt = blocked.join(told, "node").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn(
            "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label", "size", "mark")
        pairs = pairs.unionByName(dealt.groupBy("key", "i", "j").applyInArrow(run_blocks, "centre bigint, node bigint"))
    return written(pairs.distinct(), "passing")


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after adding links (a, b) between nodes."""
    if labels is None:
        return components(links)
    end = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"_{c}"))
    between = links.join(end("a"), "a", "left").join(end("b"), "b", "left").select(
        F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).filter("a <> b").distinct()
    found = components(between)
    moved = labels.join(found.select(F.col("node").alias("label"), F.col("label").alias("_new")), "label", "left").select(
        "node", F.coalesce("_new", "label").alias("label"))
    fresh = found.join(labels, "node", "left_anti").select("node", "label")
    return written(moved.unionByName(fresh), "labels")


def _cross(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between different labels."""
    end = lambda c, name: labels.select(F.col("node").alias(c), F.col("label").alias(name))
    return edges.join(end("centre", "_c"), "centre", "left").join(end("node", "_n"), "node", "left").filter(
        F.coalesce("_c", "centre") != F.coalesce("_n", "node")).select(edges.columns)


def similar_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash of every row: documents linked, step by step, by a
    Jaccard similarity of percent / 100 or more of their sets of ``words``-word shingles."""
    ship_code(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    whole = _sketches(docs, words, percent)
    signed = whole.filter(F.col("mark").isNotNull()).agg(F.sum(F.size("signatures"))).first()[0] or 0
    shared, slices = _shared(whole.select("node", F.explode("signatures").alias("key")), min(SLICES, max(1, -(-signed // SLICE_ROWS))))
    marks = _marks(whole, shared)
    sketches = written(whole.drop("signatures", "mark"), "nodes")
    discard(whole)

    def sets(edges: DataFrame) -> DataFrame:
        nodes = edges.select("node").unionByName(edges.select(F.col("centre").alias("node"))).distinct()
        return _sets(docs, marks, nodes, words)

    labels = None
    edges = _screened(_stars(shared), marks, percent)
    if not edges.isEmpty():
        asked = sets(edges)
        labels = _starred(edges, asked, percent)
        discard(asked)
    buckets, blocked, wide = _open(shared, labels)
    discard(*slices)
    if wide is not None:
        edges = written(_stars(wide.select("key", "node")), "stars")
        labels = _linked(edges, sets(edges), marks, labels, percent)
    pairs = _passing(buckets, blocked, marks, percent)
    if not pairs.isEmpty():
        labels = _merged(labels, _links(_compared(pairs, sets(pairs), percent)))
    return _shown(sketches, labels)


def _links(compared: DataFrame) -> DataFrame:
    return compared.filter("linked").select(F.col("centre").alias("a"), F.col("node").alias("b"))


def _starred(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Labels of the nodes that the links among the edges join."""
    # most members are settled by one comparison each
    first = edges.groupBy("node").agg(F.max(F.struct("n", "centre")).alias("most")).select(F.col("most.centre").alias("centre"), "node")
    labels = _merged(None, _links(_compared(first, sets, percent)))
    rest = _links(_compared(_cross(edges.join(first, ["centre", "node"], "left_anti"), labels), sets, percent))
    return labels if rest.isEmpty() else _merged(labels, rest)


def _open(shared: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Buckets (key, node, label) of two labels or more, one of those with the same members: those of at most ``LISTED`` members, those
    that are compared by blocks (with n, their members), if any, and the others, if any."""
    if labels is None:
        rows = shared.withColumn("label", F.col("node"))
    else:
        rows = shared.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    rows = written(rows, "labelled")
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"),
                                   F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    keys = written(keys.filter("lo <> hi").groupBy("x", "y", "n").agg(F.min("key").alias("key")).select("key", "n"), "keys")
    some = lambda which: rows.join(keys.filter(which).select("key"), "key", "left_semi")
    n = F.col("n")
    large = n > max(LISTED, PAIRS_PER_ROW * MARKS_PER_PAIR)
    blocked = keys.filter((n > LISTED) & ~large)
    return (some(n <= LISTED), None if blocked.isEmpty() else rows.join(blocked, "key"),
            None if keys.filter(large).isEmpty() else written(some(large), "wide"))


def _dealt(told: DataFrame, labels: DataFrame) -> DataFrame:
    """Buckets (key, node, label) of different labels, by the first elements in which the members differ from their
    centre: elements of members outside the centre's component, those that the fewest of these have first."""
    end = lambda c, name: labels.select(F.col("node").alias(c), F.col("label").alias(name))
    told = told.join(end("centre", "_c"), "centre", "left").join(end("node", "label"), "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    told = told.withColumn("outside", F.col("label") != F.coalesce("_c", "centre")).withColumn(
        "first", F.when(F.col("outside"), F.col("outer")).otherwise(F.col("inner"))).withColumn("all", F.size("tokens"))
    apart = told.select("centre", "node", "label", "outside", "first", "all", F.explode("tokens").alias("token"))
    rare = apart.filter("outside").groupBy("centre", "token").agg(F.count(F.lit(1)).alias("members"))
    by_rarity = Window.partitionBy("centre", "node").orderBy("members", "token")
    # elements of no outside member come before the others
    found = apart.join(rare, ["centre", "token"]).withColumn("at", F.row_number().over(by_rarity)).withColumn(
        "before", F.col("all") - F.count(F.lit(1)).over(Window.partitionBy("centre", "node")))
    rows = written(found.filter("before + at <= first").select(F.xxhash64("centre", "token").alias("key"), "node", "label"), "dealt")
    many = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("key")
    buckets = written(rows.join(many, "key", "left_semi").distinct(), "buckets")
    discard(rows)
    return buckets


def _pairs_left(buckets: DataFrame) -> DataFrame | None:
    """Distinct pairs (centre, node) of different labels in a bucket, if they are few for each row; else None.

    One of a pair is always outside the bucket's most frequent label, so the work is counted as the
    members outside times all members, without listing them.
    """
    by_label = buckets.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    per_key = by_label.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("most"))
    per_key = written(per_key.select("key", "n", F.col("most.label").alias("main"), (F.col("n") * (F.col("n") - F.col("most.n"))).alias("work")), "work")
    total = per_key.agg(F.sum("work"), F.sum("n")).first()
    if total[0] is not None and total[0] > PAIRS_PER_ROW * total[1]:
        return None
    open_ = buckets.join(per_key.select("key", "main"), "key")
    outside = open_.filter("label <> main").select("key", F.col("node").alias("centre"), F.col("label").alias("_own"))
    # of two members outside, one pair is enough
    return outside.join(open_, "key").filter("label <> _own AND (label = main OR centre < node)").select("centre", "node").distinct()


def _linked(edges: DataFrame, sets: DataFrame, marks: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame | None:
    """Labels after joining all nodes that links join, from the first stars on."""
    if labels is None:
        labels = edges.select("node", F.col("node").alias("label")).limit(0)
    while True:
        rest = _screened(_cross(edges.select("centre", "node"), labels), marks, percent)
        if not rest.isEmpty():
            labels = _merged(labels, _links(_compared(rest, sets, percent)))
        # centres with two members or more, one of which is not in the centre's component
        apart = _cross(edges.select("centre", "node"), labels).select("centre").distinct()
        open_ = edges.join(written(apart, "apart"), "centre", "left_semi")
        many = open_.groupBy("centre").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("centre")
        open_ = written(open_.join(many, "centre", "left_semi").select("centre", "node"), "open")
        if open_.isEmpty():
            return labels
        told = _compared(open_, sets, percent, apart=True)
        buckets = _dealt(told, labels)
        discard(told)
        # a turn deals each member to many buckets, so those that can be listed end here
        listed, blocked, wide = _open(buckets.select("key", "node"), labels)
        found = _passing(listed, blocked, marks, percent)
        discard(buckets)
        if not found.isEmpty():
            labels = _merged(labels, _links(_compared(found, sets, percent)))
        if wide is None:
            return labels
        pairs = _pairs_left(wide)
        if pairs is not None:
            last = _compared(_screened(written(pairs, "pairs"), marks, percent), sets, percent)
            return _merged(labels, _links(last))
        # every turn starts from written tables, so plans stay short however many turns there are
        edges = written(_stars(wide.select("key", "node")), "stars")


def _shown(sketches: DataFrame, labels: DataFrame | None) -> DataFrame:
    least = sketches.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    if labels is None:
        named = least.withColumnRenamed("least", "component_id")
    else:
        least = least.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        named = least.join(least.groupBy("label").agg(F.min("least").alias("component_id")), "label").select("node", "component_id")
    return sketches.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "text_hash")

"""Conversation prefix trie as a z-fast trie.

Prefixes are known by hashes that are exclusive ors of turn hashes salted with
their depth, so a conversation's prefix keys are running totals
(``ordered.numbered``), and no task holds a whole conversation. Conversations
that are alike through and through go in once, as one string.

A compacted node is an edge: the stretch of depths from its parent's extent (not
included) to its own. The table of nodes is hashed by the handle of each: its
prefix at the two-fattest depth of that stretch, the one with most zeros at the
end in binary. A string finds its exit node by fat binary search over all
strings at once: every round looks up each string's prefix at the two-fattest
depth of what is left of its interval, goes below the extent of a node whose
extent it has, and gives up the upper half where no handle is found. Strings
that leave an edge half way find the place by bisection against the edge's
string. Batches are inserted one after another: a batch that has found its
places splits the edges where its strings leave, and adds compacted nodes for
what hangs below, the later batches thus group only what is new in them.
At the end the edges are expanded to one node for each depth.

Totals of subtrees need no walk: every string adds to each explicit node on its
path what it has below (strings on a node combine on the map side). Bytes below
a node are counted once for each distinct node by giving them to the node's
smallest conversation, which owns the lower end of its own path.

Defined results: null roles and texts count as empty; a null turn comes first;
rows with the same turn are ordered by role and text digest; rows that repeat
are turns of their own; rows without a conv_id belong to no conversation; an
empty table has no members, so no nodes. Other columns, whatever their names,
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerflow.llm.common import crc32_sql, ship_code, small, written
from layerflow.llm.ordered import numbered

GIVEN = 5       # a conversation c begins with turns of conversation c - c % GIVEN
HEADS = 9       # and has crc32(c) % HEADS of them
CLASSES = 64    # hash classes of strings
BATCHES = (4, 64)  # classes inserted after each batch: a small first one, then the rest against its trie
CHUNK = 4096    # depths of an edge that are listed at once
KEY = ["k1", "k2"]


def heads(conv: Column) -> Column:
    return (F.crc32(F.encode(conv.cast("string"), "UTF-8")) % HEADS).cast("bigint")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, d, y1, y2, bytes): turns of the rebuilt conversations from depth 1; and the conversations (c)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", role.alias("role"), F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("digest"),
        F.xxhash64(role, text).alias("x1"), F.xxhash64(F.lit(HEADS), text, role).alias("x2"), F.octet_length(text).cast("bigint").alias("bytes"))
    turns = numbered(written(turns, "turns"), ["conv_id"], ["turn", "role", "digest"], "placed").select("conv_id", F.col("_pos").alias("pos"), "x1", "x2", "bytes")
    conv = F.col("conv_id")
    first = turns.filter(F.col("pos") < HEADS - 1)
    have = first.groupBy(conv.alias("giver")).agg(F.count(F.lit(1)).alias("have"))
    every = turns.filter("pos = 0").select(conv.alias("c"), (conv - conv % GIVEN).alias("_giver"), heads(conv).alias("h"))
    every = written(every.join(have, F.col("_giver") == F.col("giver"), "left").select("c", "_giver", "h", F.least("h", F.coalesce("have", F.lit(0))).alias("given")), "conversations")
    given = first.join(every, (conv == F.col("_giver")) & (F.col("pos") < F.col("h"))).select("c", (F.col("pos") + 1).alias("d"), "x1", "x2", "bytes")
    own = turns.filter(F.col("pos") >= heads(conv)).join(small(every.select("c", "given"), 16), conv == F.col("c"))
    own = own.select("c", (F.col("given") + F.col("pos") - heads(conv) + 1).alias("d"), "x1", "x2", "bytes")
    return given.unionByName(own).select("c", "d", F.xxhash64("d", "x1").alias("y1"), F.xxhash64("x2", "d").alias("y2"), "bytes"), every.select("c")


def fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that has most zeros at the end in binary."""
    cut = F.length(F.bin(a.bitwiseXOR(b))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", b, cut), cut)


def at_depth(rows: DataFrame, paths: DataFrame, conv: str, depth: str, prefix: str, how: str = "inner", also: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with the keys of string ``conv`` at ``depth`` as <prefix>1 and <prefix>2 (and others as <prefix>_<name>)."""
    names = {"k1": f"{prefix}1", "k2": f"{prefix}2", **{c: f"{prefix}_{c}" for c in also}}
    side = paths.select(F.col("c").alias("_c"), F.col("d").alias("_d"), *[F.col(k).alias(v) for k, v in names.items()])
    return rows.join(side, (F.col(conv) == F.col("_c")) & (F.col(depth) == F.col("_d")), how).drop("_c", "_d")


def same(left: tuple[str, ...], right: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & (F.col(a) == F.col(b))
    return out


def locate(batch: DataFrame, trie: DataFrame, paths: DataFrame) -> DataFrame:
    """(c, n, base, lcp, e, e1, e2) of each string (one at least, each with a turn): depth of the lowest extent that it has, and how far it goes down the edge of its exit node."""
    state = batch.select("c", "n", F.lit(0).cast("bigint").alias("lo"), F.col("n").alias("hi"), F.lit(None).cast("bigint").alias("e"),
                         F.lit(None).cast("bigint").alias("e1"), F.lit(None).cast("bigint").alias("e2"), F.lit(None).cast("bigint").alias("rep"), F.lit(0).cast("bigint").alias("base"))
    # a handle met by many strings is a hot key of the probing side only, which adaptive execution splits
    handles = trie.select(F.col("f").alias("zf"), F.col("f1").alias("zf1"), F.col("f2").alias("zf2"), *[F.col(c).alias(f"z{c}") for c in ("e", "e1", "e2", "rep")])
    handles = small(handles, 56)
    settled = []
    while not state.isEmpty():  # fat binary search
        probe = at_depth(state.withColumn("at", fattest(F.col("lo"), F.col("hi"))), paths, "c", "at", "p")
        hit = probe.join(handles, same(("at", "p1", "p2"), ("zf", "zf1", "zf2")), "left")
        hit = at_depth(hit, paths, "c", "ze", "x", "left")
        has = F.coalesce((F.col("x1") == F.col("ze1")) & (F.col("x2") == F.col("ze2")), F.lit(False))
        found = F.col("ze").isNotNull()
        out = F.when(found & ~has, True).otherwise(False)  # its extent is not had: the exit node
        step = hit.select(
            "c", "n",
            F.when(has, F.col("ze")).when(out, F.col("at")).otherwise(F.col("lo")).alias("lo"),
            F.when(has, F.greatest("ze", "hi")).when(out, F.least(F.col("ze") - 1, F.col("n"))).otherwise(F.col("at") - 1).alias("hi"),
            *[F.when(out, F.col(f"z{c}")).alias(c) for c in ("e", "e1", "e2", "rep")],
            F.when(has, F.col("ze")).otherwise(F.col("base")).alias("base"), out.alias("exit"))
        step = written(step, "search")
        settled.append(step.filter("exit OR lo >= hi").drop("exit"))
        state = step.filter("NOT exit AND lo < hi").drop("exit")
    done = reduce(DataFrame.unionByName, settled)
    # those that stand on an extent may go some way down the edge of a child: it is known by its first depth
    stand = at_depth(done.filter("e IS NULL").drop("e", "e1", "e2", "rep").withColumn("next", F.col("base") + 1), paths, "c", "next", "p", "left")
    firsts = trie.select((F.col("a") + 1).alias("zd"), F.col("d1").alias("zd1"), F.col("d2").alias("zd2"), "e", "e1", "e2", "rep")
    stand = stand.join(small(firsts, 56), same(("next", "p1", "p2"), ("zd", "zd1", "zd2")), "left")
    on = F.col("e").isNotNull()
    stand = stand.select("c", "n", F.when(on, F.col("next")).otherwise(F.col("base")).alias("lo"),
                         F.when(on, F.least(F.col("e") - 1, F.col("n"))).otherwise(F.col("base")).alias("hi"), "e", "e1", "e2", "rep", "base")
    state = written(done.filter("e IS NOT NULL").unionByName(stand), "edge")
    ready = state.filter("lo >= hi")
    state = state.filter("lo < hi")
    while not state.isEmpty():  # bisection on the edge
        mid = at_depth(at_depth(state.withColumn("mid", F.expr("(lo + hi + 1) div 2")), paths, "c", "mid", "p"), paths, "rep", "mid", "x")
        alike = same(("p1", "p2"), ("x1", "x2"))
        step = written(mid.select("c", "n", F.when(alike, F.col("mid")).otherwise(F.col("lo")).alias("lo"),
                                  F.when(alike, F.col("hi")).otherwise(F.col("mid") - 1).alias("hi"), "e", "e1", "e2", "rep", "base"), "edge")
        ready = ready.unionByName(step.filter("lo >= hi"))
        state = step.filter("lo < hi")
    return written(ready.select("c", "n", "base", F.col("lo").alias("lcp"), "e", "e1", "e2"), "located")


def nodes_of(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """Node rows from (a, e, e1, e2, rep): with handle and first key."""
    rows = edges.withColumn("f", fattest(F.col("a"), F.col("e"))).withColumn("_first", F.col("a") + 1)
    return at_depth(at_depth(rows, paths, "rep", "f", "f"), paths, "rep", "_first", "d").drop("_first")


def insert(batch: DataFrame, trie: DataFrame | None, paths: DataFrame) -> DataFrame:
    """The trie with the strings (c, n, k1, k2) of a batch; every string ends at a node of its own."""
    if trie is None:
        zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
        places = batch.select("c", "n", zero.alias("base"), zero.alias("lcp"), none.alias("e"), none.alias("e1"), none.alias("e2"))
    else:
        places = locate(batch, trie, paths)
    # edges left half way, or at which a string ends half way, are split there
    split = places.filter("e IS NOT NULL AND lcp > base")
    split = split.groupBy("e", "e1", "e2", "lcp").agg(F.min("c").alias("c"))
    # what hangs below: distinct nodes, of which the ends and those with several children are explicit
    tails = paths.join(places.select(F.col("c").alias("_c"), "lcp", "n", "base"), (F.col("c") == F.col("_c")) & (F.col("d") > F.col("lcp"))).drop("_c")
    tails = written(tails.select("c", "d", "k1", "k2", "q1", "q2", "lcp", "n"), "tails")
    distinct = tails.groupBy("d", "k1", "k2").agg(F.min("c").alias("rep"), F.first("q1").alias("q1"), F.first("q2").alias("q2"), F.max(F.col("d") == F.col("n")).alias("ends"))
    distinct = written(distinct, "tail-nodes")
    forks = distinct.groupBy((F.col("d") - 1).alias("d"), F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m")
    points = distinct.filter("ends").select("d", "k1", "k2", "rep").unionByName(distinct.filter("NOT ends").join(forks, ["d", "k1", "k2"], "left_semi").select("d", "k1", "k2", "rep"))
    # the explicit node above: along the path of the node's string
    along = tails.join(points.withColumnsRenamed({"d": "_d", "k1": "_k1", "k2": "_k2"}), same(("d", "k1", "k2"), ("_d", "_k1", "_k2")))
    above = F.lag("d").over(Window.partitionBy("c").orderBy("d"))
    below = along.select("c", "d", "k1", "k2", "rep", F.coalesce(above, F.col("lcp")).alias("a")).filter("c = rep")
    edges = below.select("a", F.col("d").alias("e"), F.col("k1").alias("e1"), F.col("k2").alias("e2"), "rep")
    if trie is None:
        return written(nodes_of(edges, paths), "trie")
    cuts = at_depth(split, paths, "c", "lcp", "p").join(trie.select("e", "e1", "e2", "a"), ["e", "e1", "e2"])
    over = F.lag("lcp").over(Window.partitionBy("e", "e1", "e2").orderBy("lcp"))
    upper = cuts.select(F.coalesce(over, F.col("a")).alias("a"), F.col("lcp").alias("e"), F.col("p1").alias("e1"), F.col("p2").alias("e2"), F.col("c").alias("rep"))
    lowest = split.groupBy("e", "e1", "e2").agg(F.max("lcp").alias("cut"))
    lower = trie.join(lowest, ["e", "e1", "e2"]).select(F.col("cut").alias("a"), "e", "e1", "e2", "rep")
    whole = trie.join(lowest, ["e", "e1", "e2"], "left_anti")
    return written(whole.unionByName(nodes_of(edges.unionByName(upper).unionByName(lower), paths)), "trie")


def digests_of_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sha256 of the comma-joined conversations of each node, from rows sorted by node and conversation; one hash state at a time."""
    now, state = None, None
    for batch in batches:
        out = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("n", "k1", "k2", "c"))):
            if row[:3] != now:
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = row[:3], hashlib.sha256(str(row[3]).encode())
            else:
                state.update(f",{row[3]}".encode())
        yield _ends(out)
    if now is not None:
        yield _ends([(*now, state.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["n", "k1", "k2", "ends_sha256"])


def prefix_trie(conversations: DataFrame, batches: tuple[int, ...] = BATCHES) -> DataFrame:
    """One row per node (distinct sequence of first turns) of the rebuilt conversations."""
    ship_code(conversations.sparkSession)
    turns, every = rebuilt(conversations)
    runs = numbered(written(turns, "rebuilt"), ["c"], ["d"], "prefixes", sums=("bytes",), xors=("y1", "y2"))
    paths = runs.select("c", "d", F.col("_run_y1").alias("k1"), F.col("_run_y2").alias("k2"), F.col("_run_y1").bitwiseXOR(F.col("y1")).alias("q1"),
                        F.col("_run_y2").bitwiseXOR(F.col("y2")).alias("q2"), F.col("_run_bytes").alias("b"))
    ends = paths.groupBy("c").agg(F.max("d").alias("n"), F.max_by(F.struct("k1", "k2", "b"), "d").alias("s"))
    zero = F.lit(0).cast("bigint")
    ends = every.join(ends.withColumnRenamed("c", "_c"), F.col("c") == F.col("_c"), "left").select(
        "c", F.coalesce("n", zero).alias("n"), *[F.coalesce(f"s.{x}", zero).alias(x) for x in ("k1", "k2", "b")])
    ends = written(ends, "ends")
    # one string for all conversations that are alike: its smallest
    strings = written(ends.groupBy("n", "k1", "k2", "b").agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("copies")), "strings")
    paths = written(paths.join(strings.select(F.col("c").alias("_c")), F.col("c") == F.col("_c"), "left_semi"), "paths")

    trie, begin = None, 0
    group = F.pmod(F.xxhash64("c"), F.lit(CLASSES))
    for stop in batches:
        batch = written(strings.filter((F.col("n") > 0) & (group >= begin) & (group < stop)), "batch")
        if not batch.isEmpty():
            trie = insert(batch, trie, paths)
        begin = stop
    return expanded(trie, strings, paths, ends)


def expanded(trie: DataFrame | None, strings: DataFrame, paths: DataFrame, ends: DataFrame) -> DataFrame:
    """The edges as one node for each depth, with the totals of each node and its subtree."""
    zero = F.lit(0).cast("bigint")
    root = strings.sparkSession.range(1).select(zero.alias("a"), zero.alias("e"), zero.alias("e1"), zero.alias("e2"))
    explicit = root if trie is None else root.unionByName(trie.select("a", "e", "e1", "e2"))
    # (string, explicit node on its path): each string passes the root
    passing = strings.select("c", zero.alias("e"), zero.alias("e1"), zero.alias("e2"), zero.alias("be"), zero.alias("ba"), zero.alias("a"))
    if trie is not None:
        on = paths.join(small(trie.select("a", "e", "e1", "e2"), 32), same(("d", "k1", "k2"), ("e", "e1", "e2")))
        passing = passing.unionByName(on.select("c", "e", "e1", "e2", F.col("b").alias("be"), zero.alias("ba"), "a"))
    passing = written(passing.drop("ba"), "passing")
    who = strings.select(F.col("c").alias("_s"), "copies", F.col("b").alias("total"), "n")
    counts = written(passing.join(who, F.col("c") == F.col("_s")).groupBy("e", "e1", "e2").agg(
        F.min("c").alias("conv_id"), F.sum("copies").alias("n_convs"), F.first("a").alias("a"), F.first("be").alias("be")), "counts")
    # the string that owns a node is its smallest; what it owns begins where its uppermost node hangs
    top = counts.filter("e > 0").groupBy(F.col("conv_id").alias("_s")).agg(F.min("a").alias("_a"))
    top = at_depth(top, paths, "_s", "_a", "t", "left", ("b",)).select("_s", F.coalesce("t_b", zero).alias("own_from"))
    # a string is a leaf if nothing else passes its end
    leaf = strings.join(counts.select("e", "e1", "e2", "n_convs"), same(("n", "k1", "k2"), ("e", "e1", "e2"))).select(F.col("c").alias("_s"), (F.col("n_convs") == F.col("copies")).cast("bigint").alias("leaf"))
    facts = written(who.join(leaf, "_s").join(top, "_s", "left"), "string-facts")
    all_below = F.col("copies") * (F.col("total") - F.col("be"))
    once_below = F.when(F.col("own_from").isNotNull(), F.col("total") - F.greatest("be", "own_from")).otherwise(zero)
    sums = passing.join(facts, F.col("c") == F.col("_s")).groupBy("e", "e1", "e2").agg(F.sum("leaf").alias("n_leaves"), F.sum(all_below - once_below).alias("below"))
    nodes = written(counts.join(sums, ["e", "e1", "e2"]), "nodes")
    above = at_depth(nodes.filter("e > 0"), paths, "conv_id", "a", "u", "left").withColumns({"u1": F.coalesce("u1", zero), "u2": F.coalesce("u2", zero)})
    above = written(above, "edges")
    children = above.groupBy(F.col("a").alias("_a"), F.col("u1").alias("_u1"), F.col("u2").alias("_u2")).agg(F.count(F.lit(1)).alias("n_children"))
    families = written(nodes.join(children, same(("e", "e1", "e2"), ("_a", "_u1", "_u2")), "left").select(
        "e", "e1", "e2", "conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "below"), "families")
    parents = families.select(F.col("e").alias("_a"), F.col("e1").alias("_u1"), F.col("e2").alias("_u2"), F.col("conv_id").alias("above_id"))
    edges = above.join(parents, same(("a", "u1", "u2"), ("_a", "_u1", "_u2"))).select("a", "e", "e1", "e2", "be", "above_id")
    edges = families.join(edges, ["e", "e1", "e2"], "left")  # the root has none above

    steps = edges.select("*", F.explode(F.when(F.col("e") == 0, F.array(zero)).otherwise(F.sequence(F.col("a") + 1, F.col("e"), F.lit(CHUNK).cast("bigint")))).alias("_from"))
    steps = steps.select("*", F.explode(F.sequence("_from", F.least(F.col("_from") + CHUNK - 1, F.col("e")))).alias("depth")).drop("_from")
    steps = steps.withColumn("_up", F.col("depth") - 1)
    steps = at_depth(steps, paths, "conv_id", "_up", "v", "left", ("b",))
    spelled = ends.select("n", "k1", "k2", "c").repartition("n", "k1", "k2").sortWithinPartitions("n", "k1", "k2", "c")
    spelled = spelled.mapInArrow(digests_of_ends, "n bigint, k1 bigint, k2 bigint, ends_sha256 string")
    last = F.col("depth") == F.col("e")
    steps = steps.join(spelled, (F.col("depth") == F.col("n")) & same(("e", "e1", "e2"), ("n", "k1", "k2")), "left")
    return steps.select(
        "conv_id", "depth",
        F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") == F.col("a") + 1, F.col("above_id")).otherwise(F.col("conv_id")).cast("bigint").alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(F.lit(1)).cast("bigint").alias("n_children"), "n_leaves",
        (F.col("below") + F.when(F.col("depth") == 0, zero).otherwise((F.col("n_convs") - 1) * (F.col("be") - F.coalesce("v_b", zero)))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id AS c, conv_id - conv_id % 5 AS giver, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM t),
r AS (
  SELECT c, 0 AS part, pos, role, text FROM ids JOIN t ON t.conv_id = ids.giver AND t.pos < h
  UNION ALL SELECT c, 1, pos, role, text FROM ids JOIN t ON t.conv_id = ids.c AND t.pos >= h),
rebuilt AS (
  SELECT c, row_number() OVER w AS d, strlen(text) AS b,
    string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING) AS path
  FROM r WINDOW w AS (PARTITION BY c ORDER BY part, pos)),
p AS (
  SELECT c, 0 AS d, 0 AS b, '' AS node FROM ids
  UNION ALL SELECT c, d, b, sha256(path) FROM rebuilt),
l AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS up, lead(node) OVER (PARTITION BY c ORDER BY d) IS NULL AS last FROM p),
nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, min(up) AS up, min(b) AS b,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256
  FROM l GROUP BY node, d),
kids AS (SELECT up AS node, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up, d),
whole AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children, (n.n_convs - 1) * n.b AS saved FROM nodes n LEFT JOIN kids k ON n.node = k.node AND n.d = k.d),
under AS (
  SELECT a.node, a.d, sum(w.saved) AS saved_tokens, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves
  FROM whole w JOIN p o ON o.c = w.conv_id AND o.d = w.d JOIN p a ON a.c = o.c AND a.d <= o.d GROUP BY a.node, a.d)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, w.n_convs, CAST(w.n_children AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM whole w JOIN under s ON s.node = w.node AND s.d = w.d LEFT JOIN nodes u ON u.node = w.up AND u.d = w.d - 1
"""

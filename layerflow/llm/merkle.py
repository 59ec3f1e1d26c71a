"""Merkle dataset manifest: levels as parent-linked node rows, climbed by a recursive query.

Leaves are hashes of whole rows. Their places inside a tree (one for each lang)
come from ``ordered.numbered``, so a lang with a third of all rows is spread
over tasks. Every level groups runs of ``FAN`` places; a run becomes one node
row, which holds its children's digests and the id of the row above it, so a
node and its siblings are read in one look-up. The tops of the trees are the
leaves of one more tree, the root's.

The check is a Spark recursive query: it starts with every leaf's (tampered)
digest, joins the row that the current one links to, appends the siblings, and
folds the digest with them, until no row is above. A node of level k is met by
at most 8^k leaves, so the lower levels are joined by a shuffle with no hot
key; the upper levels, which everything meets, are broadcast, and their bytes
are counted first. Siblings are emitted level by level and put together at the
end, so no row drags its growing proof through the levels.

Defined results: null columns hash as ``-``; empty texts are texts of 0 bytes;
rows that repeat a doc_id are leaves of their own, ordered by leaf digest; a
null doc_id comes first in its lang and is never tampered with; null langs form
the first tree; a table of one row has that leaf as subroot and root, and the
digest of nothing as proof; an empty table gives an empty result. Other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.llm.common import BROADCAST_BYTES, crc32_sql, discard, written
from layerflow.llm.ordered import numbered

FAN = 8
NODE = ("id", "children", "parent", "slot")
NODE_BYTES = 400        # children's digests (8 x 32), two ids, slot
SHUFFLED = 2            # so many levels, the widest, are never broadcast: plans are alike at every size
TREE_BYTES = 200        # lang, tree, digest, links
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = 1000              # ranks of the root tree's levels begin above those of all others


def part(value: Column) -> Column:
    """One input of a leaf: ``-`` or byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.encode(F.concat(*[part(columns[c]) for c in FIELDS]), "UTF-8"), 256))


def hash_of(digests: Column) -> Column:
    """H of digests laid end to end: sha256 of their hex text."""
    return F.unhex(F.sha2(F.encode(F.lower(F.hex(digests)), "UTF-8"), 256))


def node_id(tree: Column, rank: Column | int, place: Column) -> Column:
    return F.concat_ws(".", tree, F.lit(rank) if isinstance(rank, int) else rank, place)


def build(nodes: DataFrame, n_top: int, name: str) -> tuple[list[tuple[int, DataFrame, int]], DataFrame]:
    """Node rows of all levels of a forest, and its tops.

    ``nodes`` holds (tree, place, n, digest, up, up_slot): a tree's nodes, how many it has, and to which row and
    slot its top will link (null: none). Returns [(rank, rows (id, rank, digest, slot, parent), their number)] and the
    tops (tree, digest).
    """
    above = TOP if name == "root" else 0
    levels, tops, rank = [], None, above
    current = nodes
    while True:
        top = current.filter("n = 1").select("tree", "digest")
        tops = top if tops is None else tops.unionByName(top)
        more = current.filter("n > 1")
        if rank > above and not n_top:
            return levels, written(tops, f"{name}-tops")
        rank += 1
        runs = more.groupBy("tree", (F.col("place") / FAN).cast("bigint").alias("run")).agg(
            F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("c"),  # at most FAN entries
            F.first("n").alias("n"), F.first("up").alias("up"), F.first("up_slot").alias("up_slot"))
        children = F.aggregate("c", F.unhex(F.lit("")), lambda a, x: F.concat(a, x["digest"]))
        rows = runs.select("tree", F.col("run").alias("place"), F.ceil(F.col("n") / FAN).cast("bigint").alias("n"), "up", "up_slot", children.alias("children"))
        rows = rows.select("*", hash_of(F.col("children")).alias("digest"), *links(rank + 1), node_id(F.col("tree"), rank, F.col("place")).alias("id"), F.lit(rank).alias("rank"))
        current = written(rows, f"{name}-level")
        found = current.agg(F.count(F.lit(1)), F.count_if(F.col("n") > 1)).first()
        n_top = found[1]
        if found[0]:
            levels.append((rank, current, found[0]))


def links(rank: int) -> list[Column]:
    """(parent, slot) of a node by its place: the run in the level above, or where the tree's top links to."""
    inside = F.col("n") > 1
    return [F.when(inside, node_id(F.col("tree"), rank, (F.col("place") / FAN).cast("bigint"))).otherwise(F.col("up")).alias("parent"),
            F.when(inside, (F.col("place") % FAN).cast("int")).otherwise(F.col("up_slot")).alias("slot")]


CLIMB = """
WITH RECURSIVE climb(tree, place, depth, doc_id, leaf, folded, siblings, parent, slot) AS (
  SELECT tree, place, depth, doc_id, leaf, folded, siblings, parent, slot FROM {start}
  UNION ALL
  SELECT {hint} c.tree, c.place, c.depth + 1, CAST(NULL AS BIGINT), CAST(NULL AS BINARY),
         unhex(sha2(encode(lower(hex(concat(substring(n.children, 1, 32 * c.slot), c.folded, substring(n.children, 32 * c.slot + 33, 1024)))), 'UTF-8'), 256)),
         concat(substring(n.children, 1, 32 * c.slot), substring(n.children, 32 * c.slot + 33, 1024)),
         n.parent, n.slot
  FROM climb c JOIN {nodes} n ON n.id = c.parent
)
SELECT * FROM climb
"""


def climb(start: DataFrame, nodes: DataFrame, broadcast: bool) -> DataFrame:
    """All rows of the climb from ``start`` through ``nodes``: one for each leaf and row met, siblings appended."""
    spark = start.sparkSession
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # the default stops at a million rows
    try:
        query = CLIMB.replace("{hint}", "/*+ BROADCAST(n) */" if broadcast else "/*+ MERGE(n) */")
        return written(spark.sql(query, start=start, nodes=nodes.select(*NODE)), "climb")
    finally:
        spark.conf.set(limit, before)
        # the recursion keeps a shuffle of its own for each level, which Spark deletes once the driver has collected its frame
        spark.sparkContext._jvm.System.gc()


def manifest(docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: leaf, subroot, root, proof digest, the root folded from its (tampered) leaf, and the verdict."""
    columns = {c: F.col(c) for c in FIELDS}
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    leaf = leaf_digest(columns)
    changed = leaf_digest(columns | {"text": F.translate("text", CAPITALS, SMALL)})
    leaves = written(docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(tampered, changed).alias("changed")), "leaves")
    placed = numbered(leaves, ["lang"], ["doc_id", "leaf"], "placed")
    discard(leaves)
    counts = written(placed.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "langs")
    trees = numbered(counts, [], ["lang"], "trees").withColumnRenamed("_pos", "tree")
    n_trees = trees.count()
    many = n_trees > 1
    trees = trees.select("lang", F.col("tree").cast("string").alias("tree"), "n",
                         (node_id(F.lit("r"), TOP + 1, (F.col("tree") / FAN).cast("bigint")) if many else F.lit(None).cast("string")).alias("up"),
                         (F.col("tree") % FAN).cast("int").alias("up_slot") if many else F.lit(None).cast("int").alias("up_slot"))
    trees = written(trees, "trees")
    near = F.broadcast(trees) if n_trees * TREE_BYTES <= broadcast_bytes else trees
    placed = placed.join(near.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")))
    start = placed.select("tree", F.col("_pos").alias("place"), "n", "up", "up_slot", "doc_id", F.col("leaf").alias("digest"), F.coalesce("changed", "leaf").alias("folded"))
    start = written(start.select("*", *links(1)), "start")

    levels, subroots = build(start, 1, "lang")
    top = subroots.join(near.select("tree"), "tree").select(
        F.lit("r").alias("tree"), F.col("tree").cast("bigint").alias("place"), F.lit(n_trees).cast("bigint").alias("n"),
        "digest", F.lit(None).cast("string").alias("up"), F.lit(None).cast("int").alias("up_slot"))
    more, root = build(written(top, "subroots"), 1, "root")
    levels += more

    room, split = broadcast_bytes, len(levels)
    while split > SHUFFLED and levels[split - 1][2] * NODE_BYTES <= room:  # the uppermost levels that fit
        split -= 1
        room -= levels[split][2] * NODE_BYTES
    nothing = F.unhex(F.lit(""))
    begin = start.select("tree", "place", F.lit(0).alias("depth"), "doc_id", F.col("digest").alias("leaf"), "folded",
                         nothing.alias("siblings"), "parent", "slot")
    steps = begin
    for some, small in ((levels[:split], False), (levels[split:], True)):
        if some:
            met = climb(begin, reduce(DataFrame.unionByName, [rows.select(*NODE) for _, rows, _ in some]), small)
            steps = met if steps is begin else steps.unionByName(met)
            # where the next climb goes on: with nothing that this one has said already
            begin = met.filter("parent IS NOT NULL").withColumns({"doc_id": F.lit(None).cast("bigint"), "leaf": F.lit(None).cast("binary"), "siblings": nothing})
            if levels[split:]:
                begin = begin.filter(F.split("parent", r"\.")[1].cast("int") >= levels[split][0])
    proof = F.aggregate(F.array_sort(F.collect_list(F.struct("depth", "siblings"))), nothing, lambda a, x: F.concat(a, x["siblings"]))
    ends = steps.groupBy("tree", "place").agg(
        F.max("doc_id").alias("doc_id"), F.max("leaf").alias("leaf"), F.max_by("folded", "depth").alias("folded"), proof.alias("proof"))
    top = root.select(F.lower(F.hex("digest"))).first()  # one row, or none if there are no documents
    subs = subroots.select(F.col("tree").alias("_tree"), F.lower(F.hex("digest")).alias("subroot"))
    subs = F.broadcast(subs) if n_trees * TREE_BYTES <= broadcast_bytes else subs
    folded = F.lower(F.hex("folded"))
    out = ends.join(subs, F.col("tree") == F.col("_tree")).withColumn("root", F.lit(top[0] if top else None).cast("string"))
    return out.select("doc_id", F.lower(F.hex("leaf")).alias("leaf"), "subroot", "root",
                      F.sha2(F.encode(F.lower(F.hex("proof")), "UTF-8"), 256).alias("proof_sha256"),
                      folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


def _part_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _levels_sql(source: str, tree: str) -> str:
    """Recursive member pair that builds the levels of a forest, one node a row."""
    return f"""SELECT {tree}, 0 AS level, pos, n, h FROM {source}
  UNION ALL
  SELECT {tree}, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM {source}_up WHERE n > 1 GROUP BY {tree}, level, pos // 8, n"""


def _sides_sql(source: str, tree: str) -> str:
    """What stands left and right of a node in its run."""
    run = f"PARTITION BY {tree}, level, pos // 8 ORDER BY pos ROWS BETWEEN"
    return f"""SELECT {tree}, level, pos, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {source}_up WHERE n > 1"""


_LEAF = " || ".join(_part_sql(c) for c in FIELDS)
_LOWER = _LEAF.replace("CAST(text AS", f"CAST(translate(text, '{CAPITALS}', '{SMALL}') AS")
SQL = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, lang, sha256({_LEAF}) AS h,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({_LOWER}) ELSE sha256({_LEAF}) END AS changed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM base),
leaves_up AS ({_levels_sql("leaves", "lang")}),
subs AS (SELECT 0 AS t, lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM leaves_up WHERE n = 1),
subs_up AS ({_levels_sql("subs", "t")}),
sides AS ({_sides_sql("leaves", "lang")}),
top_sides AS ({_sides_sql("subs", "t")}),
climb AS (
  SELECT doc_id, lang, h AS leaf, changed AS folded, '' AS proof, pos, 0 AS level, n FROM leaves
  UNION ALL
  SELECT c.doc_id, c.lang, c.leaf, sha256(s.l || c.folded || s.r), c.proof || s.l || s.r, c.pos // 8, c.level + 1, (c.n + 7) // 8
  FROM climb c JOIN sides s ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.pos = c.pos),
high AS (
  SELECT c.doc_id, c.leaf, t.h AS subroot, c.folded, c.proof, t.pos, 0 AS level, t.n FROM climb c JOIN subs t ON t.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, sha256(s.l || c.folded || s.r), c.proof || s.l || s.r, c.pos // 8, c.level + 1, (c.n + 7) // 8
  FROM high c JOIN top_sides s ON s.level = c.level AND s.pos = c.pos)
SELECT doc_id, leaf, subroot, (SELECT h FROM subs_up WHERE n = 1) AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = (SELECT h FROM subs_up WHERE n = 1) AS verified
FROM high WHERE n = 1
"""

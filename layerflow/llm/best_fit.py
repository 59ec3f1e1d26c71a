"""Best-fit packing with conflicts: documents into bins of fixed capacity.

A document longer than a bin is cut into pieces of the capacity and a rest. Pieces
are dealt into blocks by a hash, which spreads every source and every group of copies
over all blocks (rows that repeat are told apart by a number within their input partition, so the
packing of these depends on how the input is partitioned); a block is packed in one task, largest pieces first. A block's
open bins are kept in the order of what is left in them. For a piece the search
begins at the first bin with enough room and goes on to the next larger ones until
one is compatible: the tightest compatible bin. A bin carries a bitmap of its
duplicate clusters (one piece of a cluster at most, other pieces of the same
document included) and bitmaps of its sources (``per_source`` pieces of a source at most). Where no bin is
compatible a new one is opened, so every piece is placed.

Lengths are in characters. Pieces of one cluster in different blocks can't meet, so
the constraints hold for the whole result, whatever the number of blocks.

Defined results: a null or empty text is one piece of length 0; a null source is a
source of its own; a null doc_id is packed like any other; rows that repeat are copies
of each other and go to different bins; an empty table gives an empty result.
Other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.llm.common import SPACES, ship_code, text_or_empty

CAPACITY = 16_384     # characters of a bin
PER_SOURCE = 2        # pieces of one source in a bin, at most
BLOCK_PIECES = 5_000  # pieces of a block, on average: what one task packs at once


def pack(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> tuple[list[int], list[int]]:
    """Bin and place in it of each piece, in the given order; clusters below 0 never conflict."""
    order: list[tuple[int, int]] = []  # (left, bin), sorted
    holds: list[int] = []              # by bin: bitmap of clusters
    taken: list[list[int]] = []        # by bin: bitmaps of the sources with one piece, with two, ...
    bins, places = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        own, bit = 1 << source, 1 << cluster if cluster >= 0 else 0
        at = bisect_left(order, (size, -1))
        while at < len(order) and (holds[order[at][1]] & bit or taken[order[at][1]][-1] & own):
            at += 1
        if at < len(order):
            left, chosen = order.pop(at)
        else:
            left, chosen = capacity, len(holds)
            holds.append(0)
            taken.append([0] * per_source)
        bins.append(chosen)
        places.append(capacity - left)
        holds[chosen] |= bit
        for k in range(per_source):
            if not taken[chosen][k] & own:
                taken[chosen][k] |= own
                break
        insort(order, (left - size, chosen))
    return bins, places


def pieces(docs: DataFrame, cluster: Column, capacity: int) -> DataFrame:
    """doc_id, source, cluster, piece, start, length and a hash that names the piece.

    Rows alike are counted in their partition, on the map side, and numbered from that count. Between rows alike
    in all that is counted it makes no difference which one gets which number, so a retried task gives the same rows.
    """
    text = text_or_empty()
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("source"), cluster.alias("cluster"),
                       F.length(text).alias("size"), F.xxhash64("doc_id", text).alias("name"), F.spark_partition_id().alias("part"))
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("alike"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("alike").cast("int"))))
    # a row without copies in its partition is named by its contents alone
    rows = rows.withColumn("name", F.when(F.col("alike") == 1, F.col("name")).otherwise(F.xxhash64("name", "part", "copy")))
    last = F.greatest(F.ceil(F.col("size") / capacity) - 1, F.lit(0)).cast("int")
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece") * capacity
    return rows.select("doc_id", "source", "cluster", "name", "piece", start.alias("start"),
                       F.least(F.col("size") - start, F.lit(capacity)).alias("length"))


def best_fit(docs: DataFrame, cluster: Column | None = None, capacity: int = CAPACITY,
             per_source: int = PER_SOURCE, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """doc_id, piece, start, length, bin_id, bin_offset of every piece.

    ``cluster`` names a document's group of copies; by default, equal texts up to white space and case.
    """
    ship_code(docs.sparkSession)
    if cluster is None:
        cluster = F.xxhash64(F.lower(F.regexp_replace(text_or_empty(), f"[{SPACES}]+", " ")))
    rows = pieces(docs, cluster, capacity)
    # lengths are enough to count the pieces: a scan that hashes nothing
    count = docs.agg(F.sum(F.greatest(F.ceil(F.length(text_or_empty()) / capacity), F.lit(1)))).first()[0] or 0
    blocks = max(1, -(-int(count) // block_pieces))
    kind = dict(docs.dtypes)["doc_id"]

    def packed(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "name", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        cluster, seen = pd.factorize(block["cluster"], use_na_sentinel=False)
        shared = np.bincount(cluster, minlength=len(seen)) > 1
        numbers = np.where(shared, np.cumsum(shared) - 1, -1)  # only clusters with two pieces here need a bit
        source = pd.factorize(block["source"])[0]
        bins, places = pack(block["length"].tolist(), source.tolist(), numbers[cluster].tolist(), capacity, per_source)
        return pd.DataFrame({"doc_id": block["doc_id"], "piece": block["piece"], "start": block["start"], "length": block["length"],
                             "bin_id": block["block"].astype("int64") * (1 << 32) + np.array(bins, np.int64), "bin_offset": places})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("name", "piece"), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(
        packed, f"doc_id {kind}, piece int, start int, length int, bin_id bigint, bin_offset int")

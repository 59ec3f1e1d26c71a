"""Set operations and the partition check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.sources.store import union_by_name  # noqa: F401  (I1, re-exported)


def difference(actual: DataFrame, valid: DataFrame, allowed: DataFrame | None = None,
               on: str = "name") -> DataFrame:
    """``actual - valid - allowed`` by one column, as anti-joins."""
    out = actual.join(valid.select(on).distinct(), on, "left_anti")
    if allowed is not None:
        out = out.join(allowed.select(on).distinct(), on, "left_anti")
    return out


def partition_check(source: DataFrame, kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """Kept and rejected together equal the input as multisets (I4).

    The rows are first counted and their hashes (128 bits) summed by bucket,
    which is combined on the map side: a bucket whose input has the sums of its outputs
    balances. Only rows of the other buckets are grouped whole, so
    a clean split moves no rows and every difference is counted row by row.
    Output one row: input, kept, rejected, missing (in input, in no output),
    extra (in an output more often than in the input).
    """
    cols = source.columns
    sides = ["_in", "_kept", "_rej"]
    stacked = None
    for k, df in enumerate((source, kept, rejected)):
        one = df.select(*cols, F.lit(k).alias("_side"))
        stacked = one if stacked is None else stacked.unionByName(one)
    counts = [F.count_if(F.col("_side") == k).alias(name) for k, name in enumerate(sides)]
    sign = F.when(F.col("_side") == 0, F.lit(1)).otherwise(F.lit(-1))
    # halves of the hashes: their sums stay below 64 bits for 2**31 rows a bucket
    halves = [F.sum(sign * half(f"_h{salt}")).alias(f"_s{salt}{i}") for salt in (1, 2)
              for i, half in enumerate((lambda c: F.shiftright(c, 32), lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))))]
    hashed = stacked.select("_side", *[_hash64(cols, salt).alias(f"_h{salt}") for salt in (1, 2)]).withColumn("_bk", _bucket("_h1"))
    buckets = hashed.groupBy("_bk").agg(*counts, *halves)
    off = F.col("_in") != F.col("_kept") + F.col("_rej")
    for salt in (1, 2):
        off = off | (F.col(f"_s{salt}0") != 0) | (F.col(f"_s{salt}1") != 0)
    rows = stacked.withColumn("_bk", _bucket(_hash64(cols, 1))).join(F.broadcast(buckets.where(off).select("_bk")), "_bk", "left_semi")
    per_row = rows.groupBy(*cols).agg(*counts)
    out = F.col("_kept") + F.col("_rej")
    zero = F.lit(0).cast("bigint")
    parts = buckets.select(*sides, zero.alias("missing"), zero.alias("extra")).unionByName(per_row.select(
        *[zero.alias(c) for c in sides], F.greatest(F.col("_in") - out, zero).alias("missing"), F.greatest(out - F.col("_in"), zero).alias("extra")))
    names = {"_in": "input", "_kept": "kept", "_rej": "rejected", "missing": "missing", "extra": "extra"}
    return parts.agg(*[F.sum(c).cast("bigint").alias(name) for c, name in names.items()])


CHECK_BUCKETS = 1 << 16  # of partition_check: at most so many sums for each task


def _bucket(row_hash: Column | str) -> Column:
    return F.pmod(F.col(row_hash) if isinstance(row_hash, str) else row_hash, F.lit(CHECK_BUCKETS)).cast("int")


def _hash64(cols: list[str], salt: int) -> Column:
    """64-bit hash of a row; nulls count by their place (the hash function itself passes over them)."""
    return F.xxhash64(F.lit(salt), *[p for c in cols for p in (F.col(c), F.col(c).isNull())])


def _row_hash(cols: list[str], salt: int) -> Column:
    """``_hash64`` as a number whose sums don't overflow."""
    return _hash64(cols, salt).cast("decimal(28,0)")


def fingerprint_check(source: DataFrame, kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """Whether kept and rejected together equal the input as multisets, without grouping rows (I4).

    Sums of two 64-bit row hashes don't depend on order and add up over frames, so each side is
    one scan and only one row for each task moves. Equal multisets always
    balance; others do with a chance of about 2**-128. ``unbalanced_rows`` names the rows where they don't.
    Output one row: input, kept, rejected, balanced. Empty frames count 0 rows and balance.
    """
    cols = source.columns
    sides = [(source, "input", 1), (kept, "kept", -1), (rejected, "rejected", -1)]
    sums = []
    for df, name, sign in sides:
        sums.append(df.select(F.lit(name).alias("_side"), F.lit(sign).alias("_sign"),
                              *[_row_hash(cols, salt).alias(f"_h{salt}") for salt in (1, 2)]))
    stacked = sums[0].unionByName(sums[1]).unionByName(sums[2])
    per_side = stacked.groupBy("_side", "_sign").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_h1").alias("h1"), F.sum("_h2").alias("h2"))
    total = lambda c: F.coalesce(F.sum(F.col(c) * F.col("_sign")), F.lit(0))
    count = lambda name: F.coalesce(F.sum(F.when(F.col("_side") == name, F.col("n"))), F.lit(0)).cast("bigint").alias(name)
    # hashes of one side stay below 2**63 times its rows: three sides fit the type
    return per_side.agg(*[count(name) for _, name, _ in sides],
                        ((total("n") == 0) & (total("h1") == 0) & (total("h2") == 0)).alias("balanced"))


def unbalanced_rows(source: DataFrame, kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """The distinct rows that the input has more often (missing) or less often (extra) than kept and rejected together."""
    cols = source.columns
    stacked = source.select(*cols, F.lit(1).alias("_sign"))
    for df in (kept, rejected):
        stacked = stacked.unionByName(df.select(*cols, F.lit(-1).alias("_sign")))
    return stacked.groupBy(*cols).agg(F.sum("_sign").alias("_d")).filter("_d <> 0").select(
        *cols, F.greatest("_d", F.lit(0)).cast("bigint").alias("missing"), F.greatest(-F.col("_d"), F.lit(0)).cast("bigint").alias("extra"))

"""Grouped statistics attached back onto rows.

Every statistic here is a ``groupBy().agg()`` (partial aggregation on the
map side, so a hot group is pre-reduced before the shuffle) followed by an
equi-join of the small per-group table back onto the rows. The join is left
to AQE: it broadcasts the grouped table when its measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise runs a
sort-merge join whose skewed partitions it splits. A ``Window.partitionBy``
over the same keys would instead send each whole group to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerflow.functions.text import strip
from layerflow.session import scratch_path

# Fixed value: the IQR multiplier for the outlier fences.
IQR_FACTOR = 1.5


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Frequencies of trimmed, non-blank text per column in one pass (F1).

    Output: ``column, value, count``. All columns are unpivoted into one
    stream and counted by a single aggregation (one shuffle for all).
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), strip(F.col(c).cast("string")).alias("value"))
        for c in cols
    ])).alias("kv")
    return (df.select(pairs).select("kv.column", "kv.value")
            .where(F.col("value").isNotNull() & (F.col("value") != ""))
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))


def attach_frequency(df: DataFrame, cols: list[str], prefix: str = "_freq_") -> DataFrame:
    """Add ``<prefix><col>`` = batch frequency of the row's trimmed value.

    Blank or NULL values get a NULL frequency.
    One grouped count per column (each scan reads only that column; the
    counts are combined on the map side), joined back on the trimmed value.
    The per-value tables are small for category columns and AQE broadcasts
    them from their measured size; otherwise it splits skewed partitions.
    """
    out = df
    for c in cols:
        fc = f"{prefix}{c}"
        v = strip(F.col(c).cast("string"))
        side = (df.select(v.alias(f"_fv_{c}")).where(F.col(f"_fv_{c}").isNotNull() & (F.col(f"_fv_{c}") != ""))
                .groupBy(f"_fv_{c}").agg(F.count(F.lit(1)).alias(fc)))
        out = (out.join(side, strip(out[c].cast("string")) == side[f"_fv_{c}"], "left")
               .drop(f"_fv_{c}"))
    return out


# Largest per-group table that is broadcast after its rows were counted.
BROADCAST_MAX_ROWS = 2_000_000


def join_small(df: DataFrame, small: DataFrame, keys, how: str = "left",
               check: bool = False, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join a per-group table onto the rows, broadcasting it only behind a size check.

    With ``check`` the grouped table's rows are counted first (one small job);
    at most ``max_rows`` rows it is broadcast, so the big side is never
    shuffled by a possibly hot group key. Above that, or without a check, the
    choice is AQE's: broadcast when the measured size is small, else a
    sort-merge join whose skewed partitions AQE splits.
    """
    if check and small.count() <= max_rows:
        small = F.broadcast(small)
    return df.join(small, on=keys, how=how)


def group_mean(df: DataFrame, keys: list[str], col: str, alias: str = "group_mean") -> DataFrame:
    """Mean of ``col`` per group (F10). Output: keys + alias."""
    return df.groupBy(*keys).agg(F.avg(col).alias(alias))


def attach_group_stat(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Left equi-join of a per-group table onto the rows.

    Rows whose key has a NULL part never match, like a pandas groupby that
    drops NULL keys.
    """
    return df.join(stats, on=keys, how="left")


def exact_quantiles(df: DataFrame, keys: list[str], col: str, probs: list[float],
                    partitions: int | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Exact per-group quantiles with linear interpolation, without one task per group.

    1. distinct (group, value) with counts (map-side combined: copies collapse);
    2. range-partitioned by (group, value), so a hot group is spread over
       many partitions in value order;
    3. running counts inside each partition, plus the rows of the group in
       earlier partitions (a small per-partition table) = global rank range;
    4. the ranks ``floor/ceil((n-1)q)`` of every (group, q) are located in
       their range partition and picked by an equi-join on (group, partition);
       interpolation in the same arithmetic as Spark's ``percentile``, so the
       results are equal to its results bit for bit.
    The range-partitioned distinct table is written once under the shared
    checkpoint folder. The per-partition tables are broadcast only after a row count (at most
    ``max_rows``); otherwise the joins are sort-merge joins on (group,
    partition), a key no larger than one partition.
    A NULL key part is a group of its own, as in ``groupBy``: the keys travel as
    one struct, which is never NULL and whose NULL parts are equal in joins.
    Output: keys + ``q<i>`` per probability (double).
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names, keys = keys, ["_key"]
    v = F.col(col).cast("double")
    vc = (df.where(v.isNotNull()).groupBy(F.struct(*names).alias("_key"), v.alias("_v"))
          .agg(F.count(F.lit(1)).alias("_c")))
    ranged = vc.repartitionByRange(n_parts, *keys, "_v").withColumn("_pid", F.spark_partition_id())
    # written once to the shared folder: the consumers and the broadcast checks below read the
    # same partition ids instead of re-running the aggregation and the range sampling each time
    path = scratch_path(spark, "quantiles")
    ranged.write.parquet(path)
    ranged = spark.read.parquet(path)
    local = ranged.withColumn("_cum", F.sum("_c").over(
        Window.partitionBy(*keys, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))
    per_part = ranged.groupBy(*keys, "_pid").agg(F.sum("_c").alias("_t"))
    offsets = per_part.withColumn("_off", F.coalesce(F.sum("_t").over(
        Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranks = (join_small(local, offsets.select(*keys, "_pid", "_off"), [*keys, "_pid"], how="inner",
                        check=True, max_rows=max_rows)
             .select(*keys, "_pid", "_v", (F.col("_cum") + F.col("_off") - F.col("_c")).alias("_first"),
                     (F.col("_cum") + F.col("_off") - 1).alias("_last")))
    n = per_part.groupBy(*keys).agg(F.sum("_t").alias("_n"))
    targets = n.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_qi"), ((F.col("_n") - 1) * F.lit(p)).alias("_h")) for i, p in enumerate(probs)
    ])).alias("t")).select(*keys, "t._qi", "t._h",
                           F.floor("t._h").cast("bigint").alias("_lo"), F.ceil("t._h").cast("bigint").alias("_hi"))
    # every target rank lies in exactly one range partition of its group: find it in the small
    # per-partition span table, then match values on (group, partition) — a key no larger than a
    # partition, so even a hot group is spread when the targets are too many to broadcast.
    # The key struct is never NULL, so plain equality is exact.
    spans = offsets.select(*keys, "_pid", F.col("_off").alias("_s0"), (F.col("_off") + F.col("_t") - 1).alias("_s1"))

    def pick(rank_col: str, out: str) -> DataFrame:
        located = (targets.select(*keys, "_qi", "_h", F.col(rank_col).alias("_r")).join(spans, keys)
                   .where(F.col("_r").between(F.col("_s0"), F.col("_s1"))).drop("_s0", "_s1"))
        hit = join_small(ranks, located, [*keys, "_pid"], how="inner", check=True, max_rows=max_rows).where(
            F.col("_r").between(F.col("_first"), F.col("_last")))
        return hit.select(*[F.col(k).alias(f"{out}_{k}") for k in keys], F.col("_qi").alias(f"{out}_qi"),
                          "_h", F.col("_r").alias(f"{out}_rank"), F.col("_v").alias(f"{out}_v"))

    lo, hi = pick("_lo", "l"), pick("_hi", "u").drop("_h")
    both = lo.join(hi, [F.col(f"l_{k}") == F.col(f"u_{k}") for k in keys] + [F.col("l_qi") == F.col("u_qi")])
    # the arithmetic of ``percentile``: another order of the operations differs in the last bits
    q = F.when(F.col("l_v") == F.col("u_v"), F.col("l_v")).otherwise(
        (F.col("u_rank") - F.col("_h")) * F.col("l_v") + (F.col("_h") - F.col("l_rank")) * F.col("u_v"))
    return (both.select(*[F.col(f"l_{k}").alias(k) for k in keys], F.col("l_qi").alias("_qi"), q.alias("_q"))
            .groupBy(*keys).pivot("_qi", list(range(len(probs)))).agg(F.first("_q"))
            .select(*[F.col("_key")[k].alias(k) for k in names], *[F.col(str(i)).alias(f"q{i}") for i in range(len(probs))]))


# Largest group whose exact quartiles are computed inside one task (Spark's
# ``percentile`` keeps a value -> count map per group; 2 M entries fit easily).
HOT_GROUP_ROWS = 2_000_000


def largest_group(df: DataFrame, keys: list[str], col: str) -> int:
    """Rows of the largest group (one small aggregation job)."""
    row = (df.where(F.col(col).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
           .agg(F.max("_n").alias("m")).collect()[0])
    return int(row["m"] or 0)


def iqr_bounds(df: DataFrame, keys: list[str], col: str, factor: float = IQR_FACTOR,
               accuracy: int | None = None, method: str = "auto",
               hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Per-group quartiles and fences.

    Output: keys, ``q1``, ``q3``, ``iqr``, ``lower``, ``upper``. Quartiles are
    exact with linear interpolation, like pandas. ``"percentile"`` uses
    Spark's exact aggregate (a per-group value map merged in one task);
    ``"distributed"`` never holds a group in one task (``exact_quantiles``);
    ``"auto"`` (default) measures the largest group and uses the distributed
    form only when some group has more than ``hot_rows`` rows; both work on
    doubles and give the same bits, so the switch never moves a fence. With
    ``accuracy`` set, ``percentile_approx`` is used instead (bounded, approximate).
    """
    if accuracy is None and method == "auto":
        method = "distributed" if largest_group(df, keys, col) > hot_rows else "percentile"
    if accuracy is not None:
        qs = F.percentile_approx(F.col(col), F.array(F.lit(0.25), F.lit(0.75)), accuracy)
    elif method == "percentile":
        qs = F.percentile(F.col(col).cast("double"), F.array(F.lit(0.25), F.lit(0.75)))
    else:
        qs = None
    if qs is None:
        grouped = exact_quantiles(df, keys, col, [0.25, 0.75]).select(*keys, F.array("q0", "q1").alias("_q"))
    else:
        grouped = (df.where(F.col(col).isNotNull())
                   .groupBy(*keys).agg(qs.alias("_q")))
    q1, q3 = F.col("_q")[0].cast("double"), F.col("_q")[1].cast("double")
    return grouped.select(
        *keys,
        q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"),
        (q1 - F.lit(factor) * (q3 - q1)).alias("lower"),
        (q3 + F.lit(factor) * (q3 - q1)).alias("upper"),
    )


def outside(col: Column | str, lower: Column | str = "lower", upper: Column | str = "upper") -> Column:
    """Strictly outside the fences; no fences (NULL group) is never an outlier."""
    c = F.col(col) if isinstance(col, str) else col
    lo = F.col(lower) if isinstance(lower, str) else lower
    hi = F.col(upper) if isinstance(upper, str) else upper
    return F.coalesce((c < lo) | (c > hi), F.lit(False))


def iqr_flag(df: DataFrame, keys: list[str], col: str, flag: str = "_outlier",
             factor: float = IQR_FACTOR, accuracy: int | None = None) -> DataFrame:
    """Rows plus a boolean outlier flag against their group's IQR fences."""
    bounds = iqr_bounds(df, keys, col, factor, accuracy).select(*keys, "lower", "upper")
    return (attach_group_stat(df, bounds, keys)
            .withColumn(flag, outside(col))
            .drop("lower", "upper"))

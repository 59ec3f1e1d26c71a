"""Data profile as DataFrames.

One aggregation pass covers all numeric columns; one unpivot + grouped
count covers all text columns. Top-k and sorted samples use
``row_number() <= k`` per column, which Spark plans as a partial
``WindowGroupLimit`` before the shuffle, so no task holds a whole column's
distinct values. Distinct counts are exact by default (from the frequency
table, one shuffle for all columns); ``approx=True`` swaps in
``approx_count_distinct`` for very wide or high-cardinality data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.functions.text import extract_pair, strip
from layerflow.operators.groups import HOT_GROUP_ROWS, exact_quantiles, value_counts

# Sizes of the profile's lists, the floor-range pattern, the
# block format classes and the rare-category threshold.
TOP_VALUES = 20
DISTINCT_SAMPLE = 50
OTHER_SAMPLE = 20
RANGE_PATTERN = r"^([0-9]{2}) TO ([0-9]{2})$"
NUMERIC_FORMAT = r"^[0-9]+$"
ALNUM_FORMAT = r"^[0-9]+[A-Za-z]+$"
RARE_BELOW = 5

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, _NUMERIC)]


def _unpivot(df: DataFrame, cols: list[str], value: str = "value") -> DataFrame:
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias(value)) for c in cols]))
    return df.select(pairs.alias("kv")).select("kv.column", f"kv.{value}")


def profile_base(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Per column: dtype, rows, nulls, null % (2 dp), distinct non-null values (F2)."""
    cols = cols or df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(cols)]
    if approx:
        aggs += [F.approx_count_distinct(F.col(c)).alias(f"d_{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    rows = F.col("_rows")
    per_col = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                 F.col(f"n_{i}").alias("non_null"),
                 (F.col(f"d_{i}") if approx else F.lit(None).cast("bigint")).alias("_d"))
        for i, c in enumerate(cols)]))
    base = one.select(rows.cast("bigint").alias("row_count"), per_col.alias("p")).select(
        "p.column", "p.dtype", "row_count",
        (F.col("row_count") - F.col("p.non_null")).cast("bigint").alias("null_count"),
        F.round(F.when(F.col("row_count") > 0, (F.col("row_count") - F.col("p.non_null")) * 100.0 / F.col("row_count"))
                .otherwise(0.0), 2).alias("null_pct"),
        F.col("p._d").alias("distinct_count"))
    if approx:
        return base
    distinct = (_unpivot(df, cols).where(F.col("value").isNotNull())
                .groupBy("column", "value").agg(F.lit(1).alias("_one"))
                .groupBy("column").agg(F.count(F.lit(1)).cast("bigint").alias("_dc")))
    return (base.drop("distinct_count").join(distinct, "column", "left")
            .select("column", "dtype", "row_count", "null_count", "null_pct",
                    F.coalesce("_dc", F.lit(0).cast("bigint")).alias("distinct_count")))


def largest_distinct(df: DataFrame, cols: list[str]) -> int:
    """Approximate distinct values of the most varied column (one small aggregation job)."""
    if not cols:
        return 0
    row = df.agg(*[F.approx_count_distinct(F.col(c)).alias(f"d{i}") for i, c in enumerate(cols)]).collect()[0]
    return max(int(v or 0) for v in row)


def profile_numeric(df: DataFrame, cols: list[str] | None = None, accuracy: int | None = None,
                    method: str = "auto", hot_values: int = HOT_GROUP_ROWS) -> DataFrame:
    """Per numeric column: min, max, mean, sample std, q1, median, q3.

    Exact quartiles (linear, like pandas). ``"percentile"`` is one pass, but
    Spark's ``percentile`` merges a value -> count map of the whole column in
    one task; ``"distributed"`` unpivots the columns and uses
    ``exact_quantiles`` with the column name as the group, so no task holds
    a column's distinct values. ``"auto"`` (default) counts rows and, above
    ``hot_values`` rows, measures distinct values (HyperLogLog); the
    distributed form is used when some column has more than ``hot_values``.
    ``accuracy`` selects ``percentile_approx`` (bounded, approximate).
    """
    cols = cols or numeric_columns(df)
    if accuracy is None and method == "auto":
        # a row count reads no column; no column has more distinct values than the table has rows
        few = df.count() <= hot_values or largest_distinct(df, cols) <= hot_values
        method = "percentile" if few else "distributed"
    qs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    with_q = accuracy is not None or method == "percentile"
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"), F.avg(x).alias(f"av{i}"),
                 F.stddev_samp(x).alias(f"sd{i}")]
        if with_q:
            q = F.percentile(x, qs) if accuracy is None else F.percentile_approx(x, qs, accuracy)
            aggs.append(q.alias(f"q{i}"))
    one = df.agg(*aggs)

    def qpart(i: int, j: int):
        return F.col(f"q{i}")[j].cast("double") if with_q else F.lit(None).cast("double")

    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"mn{i}").alias("min"), F.col(f"mx{i}").alias("max"),
                 F.col(f"av{i}").alias("mean"), F.col(f"sd{i}").alias("std"),
                 qpart(i, 0).alias("q1"), qpart(i, 1).alias("median"), qpart(i, 2).alias("q3"))
        for i, c in enumerate(cols)]))
    stats = one.select(rows.alias("p")).select("p.*")
    if with_q:
        return stats
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("kv")
    ).select("kv.column", "kv.value")
    quart = exact_quantiles(values, ["column"], "value", [0.25, 0.5, 0.75])
    return (stats.drop("q1", "median", "q3").join(quart, "column", "left")
            .select("column", "min", "max", "mean", "std", F.col("q0").alias("q1"),
                    F.col("q1").alias("median"), F.col("q2").alias("q3")))


def _ranked(counts: DataFrame, order: list, k: int) -> DataFrame:
    w = Window.partitionBy("column").orderBy(*order)
    return counts.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def profile_top_values(df: DataFrame, cols: list[str] | None = None, k: int = TOP_VALUES) -> DataFrame:
    """Per text column the ``k`` most frequent values (count desc, value asc)."""
    cols = cols or text_columns(df)
    counts = (_unpivot(df, cols).where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).cast("bigint").alias("count")))
    return _ranked(counts, [F.desc("count"), F.asc("value")], k)


def profile_distinct_sample(df: DataFrame, cols: list[str] | None = None, k: int = DISTINCT_SAMPLE) -> DataFrame:
    """Per text column the first ``k`` distinct non-null values in sort order."""
    cols = cols or text_columns(df)
    distinct = _unpivot(df, cols).where(F.col("value").isNotNull()).distinct()
    return _ranked(distinct, [F.asc("value")], k)


def profile_header(df: DataFrame, name: str) -> DataFrame:
    """Dataset name, rows, columns, time of the profile."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count")).select(
        F.lit(name).alias("dataset_name"), "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.current_timestamp().alias("generated_at"))


def range_text_profile(df: DataFrame, col: str, pattern: str = RANGE_PATTERN) -> DataFrame:
    """Lowest low, highest high, unparseable rows, anomalous rows (low > high or 0 TO 0)."""
    low, high = extract_pair(col, pattern)
    pair = low.isNotNull() & high.isNotNull()
    return df.select(low.alias("_lo"), high.alias("_hi"), pair.alias("_ok")).agg(
        F.min(F.when(F.col("_ok"), F.col("_lo"))).cast("double").alias("min_low"),
        F.max(F.when(F.col("_ok"), F.col("_hi"))).cast("double").alias("max_high"),
        F.count_if(~F.col("_ok")).cast("bigint").alias("unparseable_rows"),
        F.count_if(F.col("_ok") & ((F.col("_lo") > F.col("_hi")) | ((F.col("_lo") == 0) & (F.col("_hi") == 0))))
        .cast("bigint").alias("anomalous_rows"))


def format_class(col: str) -> F.Column:
    v = strip(F.col(col).cast("string"))
    return (F.when(v.isNull(), F.lit("null"))
            .when(v.rlike(NUMERIC_FORMAT), F.lit("numeric"))
            .when(v.rlike(ALNUM_FORMAT), F.lit("alphanumeric"))
            .otherwise(F.lit("other")))


def format_profile(df: DataFrame, col: str) -> DataFrame:
    """Rows per format class: numeric, alphanumeric, other, null."""
    return df.groupBy(format_class(col).alias("format_class")).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"))


def format_other_sample(df: DataFrame, col: str, k: int = OTHER_SAMPLE) -> DataFrame:
    """The first ``k`` distinct values of class ``other`` in sort order (F8)."""
    v = strip(F.col(col).cast("string"))
    others = df.where(format_class(col) == "other").select(v.alias("value")).distinct()
    return others.orderBy("value").limit(k)  # top-k per task, then k of those


def rare_values(df: DataFrame, cols: list[str], k: int = RARE_BELOW) -> DataFrame:
    """Trimmed non-blank values seen fewer than ``k`` times, per column."""
    return value_counts(df, cols).where(F.col("count") < k)


# Profile frames whose size is bounded by (columns x list size); written as one file.
BOUNDED_FRAMES = {"header", "base", "numeric", "top_values", "distinct_sample", "duplicates",
                  "range", "format", "format_other_sample"}


def write_profile(frames: dict[str, DataFrame], path: str) -> None:
    """Persist each profile frame as JSON under ``path/<name>``.

    Bounded frames go to one file; the others (the rare-value list grows with
    a column's distinct values) are written by every task in parallel.
    """
    for name, frame in frames.items():
        out = frame.coalesce(1) if name in BOUNDED_FRAMES else frame
        out.write.mode("overwrite").json(f"{path}/{name}")


def profile_report(df: DataFrame, text_cols: list[str], numeric_cols: list[str],
                   rare_cols: list[str], key_cols: list[str], range_col: str | None = None,
                   format_col: str | None = None, reuse=lambda d: d, rare_below: int = RARE_BELOW,
                   name: str = "dataset") -> dict[str, DataFrame]:
    """The whole profile of one dataset as frames.

    One unpivot + grouped count of all text columns is computed once
    (``reuse`` lets the caller write it) and feeds the top values, the
    distinct samples, the rare values and the text distinct counts. One
    aggregation pass covers the numeric columns, one the null counts.
    """
    counts = reuse(_unpivot(df, text_cols).where(F.col("value").isNotNull())
                   .groupBy("column", "value").agg(F.count(F.lit(1)).cast("bigint").alias("count")))
    trimmed = (counts.select("column", strip(F.col("value")).alias("value"), "count")
               .where(F.col("value") != "").groupBy("column", "value").agg(F.sum("count").cast("bigint").alias("count")))
    base = profile_base(df, text_cols + numeric_cols, approx=True).drop("distinct_count")
    distinct_text = counts.groupBy("column").agg(F.count(F.lit(1)).cast("bigint").alias("distinct_count"))
    distinct_num = (_unpivot(df, numeric_cols).where(F.col("value").isNotNull())
                    .groupBy("column").agg(F.count_distinct("value").cast("bigint").alias("distinct_count")))
    frames = {
        "header": profile_header(df, name),
        "base": base.join(distinct_text.unionByName(distinct_num), "column", "left"),
        "numeric": profile_numeric(df, numeric_cols),
        "top_values": _ranked(counts, [F.desc("count"), F.asc("value")], TOP_VALUES),
        "distinct_sample": _ranked(counts.select("column", "value"), [F.asc("value")], DISTINCT_SAMPLE),
        "rare": trimmed.where(F.col("column").isin(*rare_cols) & (F.col("count") < rare_below)),
    }
    if key_cols:
        from layerflow.operators.dedup import duplicate_rows
        frames["duplicates"] = duplicate_rows(df, key_cols)
    if range_col:
        frames["range"] = range_text_profile(df, range_col)
    if format_col:
        frames["format"] = format_profile(df, format_col)
        frames["format_other_sample"] = format_other_sample(df, format_col)
    return frames

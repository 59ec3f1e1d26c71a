"""Profile queries (F2-F9) on part, customer, lineitem and tx."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerflow.operators import profile as P
from layerflow.plans import fixtures as X
from layerflow.plans.registry import register

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("profile_base", """
WITH u AS (
  SELECT 'c_custkey' AS "column", 'bigint' AS dtype, CAST(c_custkey AS VARCHAR) AS v FROM customer
  UNION ALL SELECT 'c_name', 'string', c_name FROM customer
  UNION ALL SELECT 'c_nationkey', 'int', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT 'c_acctbal', 'double', CAST(c_acctbal AS VARCHAR) FROM customer
  UNION ALL SELECT 'c_mktsegment', 'string', c_mktsegment FROM customer)
SELECT "column", dtype, CAST(count(*) AS BIGINT) AS row_count, CAST(count(*) - count(v) AS BIGINT) AS null_count,
       round((count(*) - count(v)) * 100.0 / count(*), 2) AS null_pct, CAST(count(DISTINCT v) AS BIGINT) AS distinct_count
FROM u GROUP BY 1, 2""")
def q_profile_base(spark, sf):
    return P.profile_base(X.table(spark, sf, "customer"))


@register("profile_numeric", """
WITH u AS (
  SELECT 'l_quantity' AS "column", l_quantity AS x FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT 'l_tax', l_tax FROM lineitem)
SELECT "column", min(x) AS min, max(x) AS max, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std,
       round(quantile_cont(x, 0.25), 4) AS q1, round(quantile_cont(x, 0.5), 4) AS median, round(quantile_cont(x, 0.75), 4) AS q3
FROM u GROUP BY 1""")
def q_profile_numeric(spark, sf):
    p = P.profile_numeric(X.table(spark, sf, "lineitem"), _NUM)
    return p.select("column", "min", "max", *[F.round(c, 4).alias(c) for c in ["mean", "std", "q1", "median", "q3"]])


_TEXT_SQL = """u AS (
  SELECT 'p_name' AS "column", p_name AS value FROM part
  UNION ALL SELECT 'p_brand', p_brand FROM part
  UNION ALL SELECT 'p_type', p_type FROM part)"""


@register("profile_top_values", f"""WITH {_TEXT_SQL},
c AS (SELECT "column", value, count(*) AS count FROM u WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT "column", value, count, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value ASC) AS rank FROM c) WHERE rank <= 20""")
def q_profile_top_values(spark, sf):
    return P.profile_top_values(X.table(spark, sf, "part"), ["p_name", "p_brand", "p_type"])


@register("profile_distinct_sample", f"""WITH {_TEXT_SQL},
d AS (SELECT DISTINCT "column", value FROM u WHERE value IS NOT NULL)
SELECT "column", value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value) AS rank FROM d) WHERE rank <= 50""")
def q_profile_distinct_sample(spark, sf):
    return P.profile_distinct_sample(X.table(spark, sf, "part"), ["p_name", "p_brand", "p_type"])


@register("profile_header", """
SELECT 'lineitem' AS dataset_name, CAST(count(*) AS BIGINT) AS row_count, CAST(11 AS BIGINT) AS column_count FROM lineitem""")
def q_profile_header(spark, sf):
    return P.profile_header(X.table(spark, sf, "lineitem"), "lineitem").drop("generated_at")


@register("range_text_profile", f"""WITH {X.TX_SQL},
s AS (SELECT TRY_CAST(regexp_extract(trim(storey_range), '^([0-9]{{2}}) TO ([0-9]{{2}})$', 1) AS INTEGER) AS lo,
             TRY_CAST(regexp_extract(trim(storey_range), '^([0-9]{{2}}) TO ([0-9]{{2}})$', 2) AS INTEGER) AS hi FROM tx)
SELECT CAST(min(lo) FILTER (WHERE lo IS NOT NULL AND hi IS NOT NULL) AS DOUBLE) AS min_low,
       CAST(max(hi) FILTER (WHERE lo IS NOT NULL AND hi IS NOT NULL) AS DOUBLE) AS max_high,
       CAST(count(*) FILTER (WHERE lo IS NULL OR hi IS NULL) AS BIGINT) AS unparseable_rows,
       CAST(count(*) FILTER (WHERE lo IS NOT NULL AND hi IS NOT NULL AND (lo > hi OR (lo = 0 AND hi = 0))) AS BIGINT) AS anomalous_rows
FROM s""")
def q_range_text_profile(spark, sf):
    return P.range_text_profile(X.tx(spark, sf, row_id=False), "storey_range")


_FORMAT_SQL = """b AS (SELECT trim(CAST(c_custkey AS VARCHAR) || CASE WHEN c_acctbal < 0 THEN 'A' ELSE '' END
                         || CASE WHEN c_nationkey = 0 THEN '-' || c_mktsegment ELSE '' END) AS v FROM customer)"""


def _blocks(spark, sf):
    c = X.table(spark, sf, "customer")
    v = F.concat(c.c_custkey.cast("string"), F.when(c.c_acctbal < 0, "A").otherwise(""),
                 F.when(c.c_nationkey == 0, F.concat(F.lit("-"), c.c_mktsegment)).otherwise(""))
    return c.select(v.alias("block"))


@register("format_profile", f"""WITH {_FORMAT_SQL}
SELECT CASE WHEN v IS NULL THEN 'null' WHEN regexp_matches(v, '^[0-9]+$') THEN 'numeric'
            WHEN regexp_matches(v, '^[0-9]+[A-Za-z]+$') THEN 'alphanumeric' ELSE 'other' END AS format_class,
       CAST(count(*) AS BIGINT) AS rows FROM b GROUP BY 1""")
def q_format_profile(spark, sf):
    return P.format_profile(_blocks(spark, sf), "block")


@register("format_other_sample", f"""WITH {_FORMAT_SQL}
SELECT DISTINCT v AS value FROM b WHERE NOT regexp_matches(v, '^[0-9]+$') AND NOT regexp_matches(v, '^[0-9]+[A-Za-z]+$')
ORDER BY value LIMIT 20""")
def q_format_other_sample(spark, sf):
    return P.format_other_sample(_blocks(spark, sf), "block")

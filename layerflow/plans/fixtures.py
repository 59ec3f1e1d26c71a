"""Driver tables as layer inputs.

``tx`` maps the star schema onto the transaction schema, one row per line
item: order month, nation as town, market segment as flat type, customer
key as block, part name as street, part type as model, part size as a
floor range, quantity as floor area, ship year as lease start and the
extended price as price. Line-item keys travel along as lineage columns;
they break price ties deterministically.

Ledger-shaped frames (runs, tables, parameters, watermarks) are derived
from the driver tables too, so every query's work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.operators.dedup import ROW_ID
from layerflow.schema import NATURAL_KEY  # noqa: F401  (re-exported for queries)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

TX_LINEAGE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
TX_TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey"]
TX_LINEAGE_TYPES = {"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_suppkey": "bigint"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_file_row_id(df: DataFrame, alias: str = ROW_ID) -> DataFrame:
    """Unique, retry-stable id of each row of a file scan (path hash, row index)."""
    return df.select("*", F.struct(F.xxhash64(F.col("_metadata.file_path")).alias("f"),
                                   F.col("_metadata.row_index").alias("i")).alias(alias))


def tx(spark: SparkSession, sf_dir: str, row_id: bool = True) -> DataFrame:
    """Transactions view over lineitem, orders, customer, nation and part."""
    li = table(spark, sf_dir, "lineitem")
    if row_id:
        li = with_file_row_id(li)
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    p = table(spark, sf_dir, "part")
    # orders meet their customers before the line items do, and the line items move twice at every size of the tables
    # (by order, by part); names come last, and rows sorted by part compress well when they are written
    oc = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", F.trunc("o_orderdate", "MM").alias("_month"), "c_custkey", "c_nationkey", "c_mktsegment")
    j = (li.join(oc.hint("merge"), li.l_orderkey == oc.o_orderkey)
         .join(p.hint("merge"), li.l_partkey == p.p_partkey)
         .join(n, oc.c_nationkey == n.n_nationkey))
    cols = [
        F.date_format("_month", "yyyy-MM").alias("month"),
        F.col("n_name").alias("town"),
        F.col("c_mktsegment").alias("flat_type"),
        F.col("c_custkey").cast("string").alias("block"),
        F.col("p_name").alias("street_name"),
        F.concat(F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit(" TO "),
                 F.lpad((F.col("p_size") + 2).cast("string"), 2, "0")).alias("storey_range"),
        F.col("l_quantity").alias("floor_area_sqm"),
        F.col("p_type").alias("flat_model"),
        F.year("l_shipdate").cast("bigint").alias("lease_commence_date"),
        F.col("l_extendedprice").alias("resale_price"),
        *[F.col(x) for x in TX_LINEAGE],
    ]
    if row_id:
        cols.append(F.col(ROW_ID))
    return j.select(*cols)


# DuckDB text of the same view, for the oracle queries.
TX_SQL = """tx AS (
  SELECT strftime(o.o_orderdate, '%Y-%m') AS month,
         n.n_name AS town,
         c.c_mktsegment AS flat_type,
         CAST(c.c_custkey AS VARCHAR) AS block,
         p.p_name AS street_name,
         lpad(CAST(p.p_size AS VARCHAR), 2, '0') || ' TO ' || lpad(CAST(p.p_size + 2 AS VARCHAR), 2, '0') AS storey_range,
         l.l_quantity AS floor_area_sqm,
         p.p_type AS flat_model,
         CAST(year(l.l_shipdate) AS BIGINT) AS lease_commence_date,
         l.l_extendedprice AS resale_price,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN part p ON p.p_partkey = l.l_partkey
)"""


# ---------------------------------------------------------------- ledger-shaped frames

# Which layer an event type stands for in the derived run ledger.
EVENT_LAYER = {"view": "source", "click": "raw", "signup": "cleaned",
               "purchase": "transformed", "error": "hashed"}


def _layer_of(col: str):
    expr = None
    for k, v in EVENT_LAYER.items():
        expr = F.when(F.col(col) == k, F.lit(v)) if expr is None else expr.when(F.col(col) == k, F.lit(v))
    return expr


def runs_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ``pipeline_runs``-shaped ledger: one run per event (grows with the data)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        (F.col("event_id") + 1).cast("bigint").alias("run_id"),
        F.col("user_id").cast("bigint").alias("table_id"),
        _layer_of("event_type").alias("layer"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                          F.floor("value").cast("decimal(18,6)"))).alias("end_time"),
        F.when(F.col("value") >= 5, F.lit("SUCCEEDED")).otherwise(F.lit("FAILED")).alias("status"),
        F.floor(F.col("value") * 100).cast("bigint").alias("number_of_records"),
        F.col("props").alias("error_message"))


def tables_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ``metadata_tables``-shaped frame: one table per customer."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("bigint").alias("table_id"),
                    F.col("c_name").alias("table_name"),
                    F.col("c_mktsegment").alias("source_system"),
                    (F.col("c_acctbal") > 0).alias("active_flag"),
                    F.col("c_nationkey").cast("bigint").alias("load_order"))


def params_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ``table_parameters``-shaped frame: one parameter row per order."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").cast("bigint").alias("table_id"),
                    F.col("o_orderpriority").alias("parameter_name"),
                    F.col("o_orderstatus").alias("parameter_value"),
                    F.col("o_orderdate").alias("created_at"))


def marks_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ``table_watermarks``-shaped frame: one watermark row per event."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("bigint").alias("table_id"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("last_watermark_value"),
                    F.col("ts").alias("last_updated_at"),
                    (F.col("event_id") + 1).cast("bigint").alias("last_run_id"))


RUNS_SQL = """runs AS (
  SELECT CAST(event_id + 1 AS BIGINT) AS run_id, CAST(user_id AS BIGINT) AS table_id,
         CASE event_type WHEN 'view' THEN 'source' WHEN 'click' THEN 'raw' WHEN 'signup' THEN 'cleaned'
                         WHEN 'purchase' THEN 'transformed' WHEN 'error' THEN 'hashed' END AS layer,
         ts AS start_time, ts + to_seconds(CAST(floor(value) AS BIGINT)) AS end_time,
         CASE WHEN value >= 5 THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
         CAST(floor(value * 100) AS BIGINT) AS number_of_records, props AS error_message
  FROM events)"""

TABLES_SQL = """mt AS (
  SELECT CAST(c_custkey AS BIGINT) AS table_id, c_name AS table_name, c_mktsegment AS source_system,
         c_acctbal > 0 AS active_flag, CAST(c_nationkey AS BIGINT) AS load_order FROM customer)"""

PARAMS_SQL = """tp AS (
  SELECT CAST(o_custkey AS BIGINT) AS table_id, o_orderpriority AS parameter_name,
         o_orderstatus AS parameter_value, o_orderdate AS created_at FROM orders)"""

MARKS_SQL = """tw AS (
  SELECT CAST(user_id AS BIGINT) AS table_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_watermark_value,
         ts AS last_updated_at, CAST(event_id + 1 AS BIGINT) AS last_run_id FROM events)"""

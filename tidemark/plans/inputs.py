"""Stand-ins for the job inputs, derived from the given tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.catalog import table

# labelled table: four features and a three-valued class
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_TIES = ["l_shipdate", "l_extendedprice"]

# daily series of the orders table
SERIES_COLUMNS = ["price", "n_orders", "mean_price", "top_price"]
SERIES_SQL = """
SELECT CAST(o_orderdate AS DATE) AS date,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
       count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price,
       max(o_totalprice) AS top_price
FROM orders GROUP BY 1
"""

# portfolios: one per customer; the order status is the action
ACTION_SQL = "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END"
STEP = ["o_orderdate", "o_orderkey"]
CUSTOMER_BALANCE = 1_000_000.0

# registry events: user as model, event type as stage, event id as sequence
VERSION_SQL = "CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END"
STAGE_SQL = "CASE WHEN value < 10 THEN 'None' WHEN value < 40 THEN 'Staging' WHEN value < 90 THEN 'Production' ELSE 'Archived' END"

# JSON requests with broken bodies among them
_BODY_SQL = """CASE event_type
    WHEN 'error' THEN replace(props, '"k"', '"other"')
    WHEN 'signup' THEN concat('{"k": "', CAST(event_id AS @text), '"}')
    WHEN 'view' THEN concat('not json ', props)
    WHEN 'purchase' THEN CASE event_id % 5
        WHEN 0 THEN concat('{"k": "', CAST(event_id AS @text), 'd"}')
        WHEN 1 THEN concat(props, ' junk')
        WHEN 2 THEN concat(props, ', ', props)
        ELSE concat('{"k": "v', CAST(event_id AS @text), '"}') END
    ELSE props END"""


def body_sql(text_type: str) -> str:
    """The request body expression, with the engine's name for text."""
    return _BODY_SQL.replace("@text", text_type)


def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *dict.fromkeys([*LINE_KEYS, *FEATURES, *LINE_TIES, "l_returnflag", "l_linestatus"])
    )


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(
            total.alias("price"),
            F.count(F.lit(1)).alias("n_orders"),
            (total / F.count(F.lit(1))).alias("mean_price"),
            F.max("o_totalprice").alias("top_price"),
        )
    )


def portfolio_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderpriority",
        *STEP,
        F.col("o_totalprice").alias("price"),
        F.expr(ACTION_SQL).alias("action"),
    )


def registry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("name"),
        F.expr(VERSION_SQL).cast("bigint").alias("version"),
        F.expr(STAGE_SQL).alias("stage"),
        F.col("event_id").alias("event_seq"),
    )


REGISTRY_SQL = f"""
SELECT concat('model_', CAST(user_id AS VARCHAR)) AS name, CAST({VERSION_SQL} AS BIGINT) AS version,
       {STAGE_SQL} AS stage, event_id AS event_seq
FROM events
"""


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as runs, event types as metric keys."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
        F.col("event_type").alias("key"),
        F.col("event_id").alias("step"),
        "value",
        F.col("ts").cast("timestamp").alias("ts"),
    )


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.expr(body_sql("STRING")).alias("body")
    )

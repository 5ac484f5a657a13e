"""Queries on sources, sinks and column operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.operators.features import encode_labels
from tidemark.operators.ordering import row_position
from tidemark.operators.splits import part_sizes, preview, row_count
from tidemark.plans.catalog import query, table
from tidemark.plans.inputs import FEATURES, LINE_KEYS, SERIES_COLUMNS, SERIES_SQL, daily_series, labelled_lines
from tidemark.plans.jobs import ingest_labelled, prepare_series
from tidemark.session import scratch_path
from tidemark.sources.metrics import push_gauges, read_gauges
from tidemark.sources.series import read_series_csv
from tidemark.sources.tables import overwrite_table, read_table
from tidemark.sources.typed import ingest_typed, labelled_schema

_SERIES_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("n_orders", T.LongType()),
        T.StructField("mean_price", T.DoubleType()),
        T.StructField("top_price", T.DoubleType()),
    ]
)
_PREPARED_SQL = f"""
WITH s AS ({SERIES_SQL}),
f AS (SELECT avg(price) pm, stddev_pop(price) ps, avg(n_orders) nm, stddev_pop(n_orders) ns,
             avg(mean_price) mm, stddev_pop(mean_price) ms, avg(top_price) tm, stddev_pop(top_price) tsd FROM s)
SELECT CAST(date AS VARCHAR) AS date,
       round((price - pm) / ps, 6) AS price, round((n_orders - nm) / ns, 6) AS n_orders,
       round((mean_price - mm) / ms, 6) AS mean_price, round((top_price - tm) / tsd, 6) AS top_price,
       CAST(coalesce(lead(price) OVER (ORDER BY date) > price, false) AS BIGINT) AS target
FROM s, f
"""


def _shown(prepared):
    return prepared.select(
        F.col("date").cast("date").cast("string").alias("date"),
        *[F.round(c, 6).alias(c) for c in SERIES_COLUMNS],
        "target",
    )


@query("ts_prepare", _PREPARED_SQL)
def ts_prepare(spark, sf_dir):
    """Daily series, z-scored and labelled with the next day's direction."""
    return _shown(prepare_series(daily_series(spark, sf_dir), "price"))


@query(
    "a1_csv_scan",
    f"SELECT CAST(date AS VARCHAR) AS date, price, n_orders, round(mean_price, 6) AS mean_price, top_price FROM ({SERIES_SQL})",
)
def a1_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "series-csv")
    daily_series(spark, sf_dir).write.option("header", True).csv(path)
    scanned = read_series_csv(spark, path, schema=_SERIES_SCHEMA)
    return scanned.withColumns(
        {"date": F.col("date").cast("date").cast("string"), "mean_price": F.round("mean_price", 6)}
    )


@query(
    "a1_csv_inferred",
    """SELECT CAST(CAST(o_orderdate AS DATE) + INTERVAL (CASE WHEN year(o_orderdate) < 2000 THEN 100 ELSE 0 END) YEAR AS DATE)::VARCHAR AS date, CAST(count(*) AS INTEGER) AS "price.1",
              CAST(max(o_orderkey) AS INTEGER) AS "last key" FROM orders GROUP BY 1""",
)
def a1_csv_inferred(spark, sf_dir):
    """Inferred types, dates such as 5-Jan-94 (two digits are years of this century), headers with a dot and a blank."""
    path = scratch_path(spark, "inferred-csv")
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("price.1"), F.max("o_orderkey").alias("last key")
    )
    texts = days.select(F.date_format("day", "d-MMM-yy").alias("date"), "`price.1`", "last key")
    texts.write.option("header", True).csv(path)
    scanned = C.select_numeric(read_series_csv(spark, path, date_formats=["yyyy-MM-dd", "d-MMM-yy"]), keep=["date"])
    return C.drop_incomplete(scanned).withColumn("date", F.col("date").cast("date").cast("string"))


@query(
    "a2_typed_ingest",
    """SELECT l_quantity, l_extendedprice, l_discount, l_tax,
              CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS target,
              l_returnflag AS target_name
       FROM lineitem""",
)
def a2_typed_ingest(spark, sf_dir):
    """Text fields under the labelled schema."""
    coded = encode_labels(labelled_lines(spark, sf_dir), "l_returnflag", "target")
    as_text = coded.select(
        *[F.col(c).cast("string").alias(c) for c in [*FEATURES, "target"]],
        F.col("l_returnflag").alias("target_name"),
    )
    return ingest_typed(as_text, labelled_schema(FEATURES))


@query("a3_series_table", _PREPARED_SQL)
def a3_series_table(spark, sf_dir):
    """CSV to a published table and back."""
    csv, path = scratch_path(spark, "series-csv"), scratch_path(spark, "series-table")
    daily_series(spark, sf_dir).write.option("header", True).csv(csv)
    overwrite_table(prepare_series(read_series_csv(spark, csv, schema=_SERIES_SCHEMA), "price"), path, True)
    return _shown(read_table(spark, path))


@query(
    "a4_table_read",
    """SELECT l_quantity, l_extendedprice, l_discount, l_tax,
              CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS target,
              l_returnflag AS target_name
       FROM lineitem""",
)
def a4_table_read(spark, sf_dir):
    path = scratch_path(spark, "labelled-table")
    coded = encode_labels(labelled_lines(spark, sf_dir), "l_returnflag", "target")
    ingest_labelled(coded.withColumn("target_name", F.col("l_returnflag")), FEATURES, path)
    return read_table(spark, path)


@query(
    "a5_table_overwrite_roundtrip",
    "SELECT o_orderkey, round(o_totalprice * 2, 2) AS o_totalprice, o_orderstatus FROM orders",
)
def a5_table_overwrite_roundtrip(spark, sf_dir):
    """First write, an overwrite computed from the table itself, then a schema change."""
    path = scratch_path(spark, "orders-table")
    orders = table(spark, sf_dir, "orders")
    overwrite_table(orders.select("o_orderkey", "o_totalprice"), path)
    doubled = read_table(spark, path).withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    overwrite_table(doubled, path)
    status = orders.select("o_orderkey", "o_orderstatus")
    overwrite_table(read_table(spark, path).join(status, "o_orderkey"), path, replace_schema=True)
    return read_table(spark, path)


@query(
    "a6_preview",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem ORDER BY 1, 2, 3, 4, l_shipdate, 5 LIMIT 5",
)
def a6_preview(spark, sf_dir):
    ordered = preview(labelled_lines(spark, sf_dir), [*LINE_KEYS, "l_shipdate", "l_extendedprice"], 5)
    return ordered.select(*LINE_KEYS, "l_extendedprice")


@query("a6_row_count", "SELECT count(*) AS rows FROM lineitem")
def a6_row_count(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


@query(
    "a7_metric_gauges",
    """SELECT event_type AS job, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY 1
       UNION ALL
       SELECT event_type, 'value_max', max(value) FROM events WHERE event_type <> 'click' GROUP BY 1""",
)
def a7_metric_gauges(spark, sf_dir):
    """Two gauges per job; a second push of one job replaces all of that job's gauges."""
    path = scratch_path(spark, "gauges")
    per_job = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("job"))
        .agg(F.count(F.lit(1)).cast("double").alias("rows"), F.max("value").alias("value_max"))
    )
    both = per_job.unpivot("job", ["rows", "value_max"], "metric", "value")
    push_gauges(both, path)
    push_gauges(both.filter((F.col("job") == "click") & (F.col("metric") == "rows")), path)
    return read_gauges(spark, path).select("job", "metric", "value")


@query(
    "e4_row_count",
    "SELECT l_linestatus, count(*) AS rows FROM lineitem GROUP BY 1",
)
def e4_row_count(spark, sf_dir):
    return part_sizes(table(spark, sf_dir, "lineitem"), "l_linestatus")


@query("b1_numeric_only", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def b1_numeric_only(spark, sf_dir):
    return C.select_numeric(table(spark, sf_dir, "orders"))


@query("b2_feature_projection", "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag FROM lineitem")
def b2_feature_projection(spark, sf_dir):
    return C.project(table(spark, sf_dir, "lineitem"), FEATURES, "l_returnflag")


@query("b3_drop_column", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def b3_drop_column(spark, sf_dir):
    return table(spark, sf_dir, "customer").drop("c_name")


@query(
    "b4_derive_column",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem",
)
def b4_derive_column(spark, sf_dir):
    net = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)
    return table(spark, sf_dir, "lineitem").withColumn("net", net).select("l_orderkey", "l_linenumber", "net")


@query("b5_dropna_any", "SELECT event_id, value FROM events WHERE event_type NOT IN ('error', 'signup')")
def b5_dropna_any(spark, sf_dir):
    """Values of two event types are made missing, one as null and one as NaN."""
    holed = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "signup", F.lit(float("nan")))
        .when(F.col("event_type") != "error", F.col("value"))
        .alias("value"),
    )
    return C.drop_incomplete(holed)


@query(
    "b6_casts",
    """SELECT event_id, CAST(CAST(event_id AS VARCHAR) AS VARCHAR) AS id_text,
              TRY_CAST(event_type AS DOUBLE) AS not_a_number,
              CAST(value > 30 AS INTEGER) AS above, CAST(floor(value) AS INTEGER) AS whole,
              CAST(CAST(CAST(ts AS DATE) AS TIMESTAMP) AS VARCHAR) AS day
       FROM events""",
)
def b6_casts(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_id").alias("id_text"),
        F.col("event_type").alias("not_a_number"),
        (F.col("value") > 30).alias("above"),
        F.floor("value").alias("whole"),
        F.col("ts").cast("date").cast("string").alias("day"),
    )
    typed = C.cast_columns(
        raw, {"id_text": "string", "not_a_number": "double", "above": "int", "whole": "int", "day": "timestamp"}
    )
    return typed.withColumn("day", F.col("day").cast("string"))


@query(
    "b7_row_key",
    "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders",
)
def b7_row_key(spark, sf_dir):
    """The time key gives rows their place; resetting it turns the place into a column counted from 0."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    placed = row_position(orders, ["o_orderdate", "o_orderkey"])
    return placed.select("o_orderkey", "o_totalprice", (F.col("position") - 1).alias("position"))


@query(
    "b8_to_vector",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price, CAST(4 AS INTEGER) AS width,
              round(l_extendedprice + l_quantity + l_discount + l_tax, 4) AS total FROM lineitem""",
)
def b8_to_vector(spark, sf_dir):
    state = C.to_vector(["l_extendedprice", "l_quantity", "l_discount", "l_tax"])
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("state", state)
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            F.col("state")[0].alias("price"),
            F.size("state").alias("width"),
            F.round(F.aggregate("state", F.lit(0.0), lambda a, v: a + v), 4).alias("total"),
        )
    )


@query(
    "b9_metric_keys",
    """SELECT replace(concat(event_type, '-value_p_value'), '-', '_') AS metric, count(*) AS rows
       FROM events GROUP BY 1""",
)
def b9_metric_keys(spark, sf_dir):
    named = C.metric_key(F.concat("event_type", F.lit("-value")), "p_value")
    return table(spark, sf_dir, "events").groupBy(named.alias("metric")).agg(F.count(F.lit(1)).alias("rows"))

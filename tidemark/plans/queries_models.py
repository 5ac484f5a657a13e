"""Queries on training, scoring, requests and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import traffic as W
from tidemark.operators.boosting import BINARY, train_binary, train_multiclass
from tidemark.operators.drift import ks_by_window, ks_by_window_sketched, window_value_counts
from tidemark.operators.evaluation import early_stop_round
from tidemark.operators.requests import parse_requests
from tidemark.operators.scoring import ForeignModel, score_batch, score_foreign, score_requests
from tidemark.operators.splits import chronological_split, random_holdout, sample_exact
from tidemark.plans.catalog import query, table
from tidemark.plans.inputs import (
    FEATURES,
    LINE_KEYS,
    LINE_TIES,
    SERIES_COLUMNS,
    body_sql,
    daily_series,
    labelled_lines,
    request_bodies,
)
from tidemark.plans.jobs import prepare_series
from tidemark.session import materialise, scratch_path
from tidemark.sources.metrics import read_gauges
from tidemark.sources.models import load_model, register_model, transition_stage
from tidemark.streaming.alerts import alert_stream, latest_alerts
from tidemark.streaming.drift import drift_stream
from tidemark.streaming.quality import quality_by_window, quality_stream
from tidemark.streaming.traffic import gauge_stream
from tidemark.streaming.scoring import read_request_stream, score_stream, score_stream_by_stage

# the training queries but g1_train_multiclass fit on an exact seeded sample of at most so many labelled rows; all score every row
FIT_ROWS = 5_000

# a class that trees can learn exactly: thirds of the quantity
_THIRD_SQL = "CASE WHEN l_quantity <= 17 THEN 0 WHEN l_quantity <= 34 THEN 1 ELSE 2 END"
_HALF_SQL = "CASE WHEN l_quantity <= 25 THEN 0 ELSE 1 END"
_SPLIT_SQL = """(SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', l_orderkey, l_linenumber, l_partkey, l_suppkey)),
                 l_shipdate, l_extendedprice) <= ceil(count(*) OVER () * 0.2::DOUBLE) AS held FROM lineitem)"""


def _fit_rows(rows, keys, ties=()):
    """All of ``rows``, or the seeded sample if there are more than ``FIT_ROWS``, drawn once for all that read it."""
    return materialise(rows if rows.count() <= FIT_ROWS else sample_exact(rows, FIT_ROWS, keys, ties=ties), "fit-rows")


def _split_lines(spark, sf_dir, rule):
    lines = labelled_lines(spark, sf_dir).withColumn("target", F.expr(rule))
    rows = materialise(random_holdout(lines, LINE_KEYS, ties=LINE_TIES), "lines")
    return (rows.filter(F.col("split") == p) for p in ("train", "test"))


def _half_model(spark, sf_dir):
    """Two classes with full rounds, stopped on a sample of the test part; also the whole test part."""
    train, test = _split_lines(spark, sf_dir, _HALF_SQL)
    fit, check = (_fit_rows(part, LINE_KEYS, LINE_TIES) for part in (train, test))
    return train_binary(fit, FEATURES, validation=check), test


@query(
    "g1_train_multiclass",
    f"SELECT {_THIRD_SQL} AS target, {_THIRD_SQL} AS prediction, count(*) AS rows FROM {_SPLIT_SQL} WHERE held GROUP BY 1, 2",
)
def g1_train_multiclass(spark, sf_dir):
    """Three-class boosting of the whole training part with the job's rounds and patience; confusion counts of the whole test part."""
    train, test = _split_lines(spark, sf_dir, _THIRD_SQL)
    model = train_multiclass(train, FEATURES, validation=test, classes=3)
    return model.score(test).groupBy("target", "prediction").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "g2_train_binary_es",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS price FROM orders GROUP BY 1),
       l AS (SELECT date, CAST(coalesce(lead(price) OVER (ORDER BY date) > price, false) AS BIGINT) AS target,
                    row_number() OVER (ORDER BY date) AS rn, count(*) OVER () AS n FROM d)
       SELECT CAST(date AS VARCHAR) AS date, target, true AS cut_at_best, true AS stopped_early
       FROM l WHERE rn > floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE)""",
)
def g2_train_binary_es(spark, sf_dir):
    """Next-day direction with validated early stopping, the test part, and whether the stop is that of the logged losses."""
    prepared = materialise(prepare_series(daily_series(spark, sf_dir), "price"), "prepared")
    rows = materialise(chronological_split(prepared, ["date"]), "direction")
    train, validation, test = (rows.filter(F.col("split") == p) for p in ("train", "validation", "test"))
    model = train_binary(train, SERIES_COLUMNS, validation=validation)
    losses = model.losses
    logged = spark.createDataFrame([("run", step, loss) for step, loss in enumerate(losses)], "run_id string, step int, value double")
    found = early_stop_round(logged, patience=BINARY["patience"]).first()
    agrees = found["best_round"] == model.rounds - 1 and found["stop_round"] == len(losses) - 1
    stopped = len(losses) < BINARY["max_rounds"]
    scored = model.score(test).where(F.col("prediction").isin(0, 1))
    return scored.select(
        F.col("date").cast("date").cast("string").alias("date"), "target",
        F.lit(agrees).alias("cut_at_best"), F.lit(stopped).alias("stopped_early"),
    )


# a fifth of the validation labels is wrong, told by the order key
_NOISY = "l_orderkey % 5 = 0"


@query(
    "g1_joint_stop",
    f"""SELECT {_THIRD_SQL} AS target, {_THIRD_SQL} AS prediction, count(*) AS rows,
               true AS losses_agree, true AS cut_agrees, true AS stopped_early FROM {_SPLIT_SQL} WHERE held GROUP BY 1, 2""",
)
def g1_joint_stop(spark, sf_dir):
    """All classes cut at the least joint loss on noisy labels; the losses again from the margins by SQL."""
    train, test = _split_lines(spark, sf_dir, _THIRD_SQL)
    fit, held = (_fit_rows(part, LINE_KEYS, LINE_TIES) for part in (train, test))
    noisy = materialise(held.withColumn("target", F.expr(f"IF({_NOISY}, (target + 1) % 3, target)")), "noisy")
    settings = {"max_rounds": 40, "step_size": 0.3, "patience": 10}
    model = train_multiclass(fit, FEATURES, validation=noisy, classes=3, **settings)
    full = train_multiclass(fit, FEATURES, classes=3, **settings)
    full.staged(noisy).select("target", "margins").createOrReplaceTempView("staged")
    again = spark.sql(
        """WITH m AS (SELECT target, step, 1 / (1 + exp(-2 * margins[0][step])) AS a, 1 / (1 + exp(-2 * margins[1][step])) AS b,
                             1 / (1 + exp(-2 * margins[2][step])) AS c
                      FROM staged LATERAL VIEW explode(sequence(0, size(margins[0]) - 1)) AS step)
           SELECT step, avg(-ln(CASE target WHEN 0 THEN a WHEN 1 THEN b ELSE c END / (a + b + c))) AS value FROM m GROUP BY step"""
    )
    logged = spark.createDataFrame(list(enumerate(model.losses)), "step int, logged double")
    both = logged.join(again, "step", "left").agg(F.max(F.abs(F.col("logged") - F.col("value"))).alias("apart"), F.count("value").alias("n")).first()
    agree = both["n"] == len(model.losses) and both["apart"] < 1e-9
    found = early_stop_round(again.withColumn("run_id", F.lit("run")), patience=settings["patience"]).first()
    cut = found["best_round"] == model.rounds - 1 and found["stop_round"] == len(model.losses) - 1
    counted = model.score(test).groupBy("target", "prediction").agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumns(
        {"losses_agree": F.lit(agree), "cut_agrees": F.lit(cut), "stopped_early": F.lit(len(model.losses) < settings["max_rounds"])}
    )


@query(
    "g2_noisy_validation",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {_HALF_SQL} AS prediction, true AS stopped_early FROM {_SPLIT_SQL} WHERE held",
)
def g2_noisy_validation(spark, sf_dir):
    """A learnable rule, validated on labels of which a fifth is wrong: every test row gets the rule's class."""
    train, test = _split_lines(spark, sf_dir, _HALF_SQL)
    fit, held = (_fit_rows(part, LINE_KEYS, LINE_TIES) for part in (train, test))
    noisy = held.withColumn("target", F.expr(f"IF({_NOISY}, 1 - target, target)"))
    model = train_binary(fit, FEATURES, validation=noisy, max_rounds=40)
    scored = model.score(test).withColumn("stopped_early", F.lit(len(model.losses) < 40))
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "prediction", "stopped_early")


_GAPS = {"discount": "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_discount END", "tax": "CASE WHEN l_suppkey % 2 = 0 THEN NULL ELSE l_tax END"}
_GAP_CLASS = f"CASE WHEN {_GAPS['discount']} IS NULL THEN 2 WHEN {_GAPS['tax']} IS NULL AND l_quantity <= 25 THEN 0 ELSE 1 END"


@query("g1_missing_values", f"SELECT l_orderkey, l_linenumber, l_partkey, {_GAP_CLASS} AS prediction FROM lineitem")
def g1_missing_values(spark, sf_dir):
    """Classes told by which features are missing, learned from a sample and found for every line."""
    lines = labelled_lines(spark, sf_dir)
    rows = materialise(lines.withColumns({"target": F.expr(_GAP_CLASS), **{n: F.expr(e) for n, e in _GAPS.items()}}), "gaps")
    model = train_multiclass(_fit_rows(rows, LINE_KEYS, LINE_TIES), ["l_quantity", *_GAPS], classes=3, max_rounds=10)
    return model.score(rows).select("l_orderkey", "l_linenumber", "l_partkey", "prediction")


@query("g3_score_batch", f"SELECT l_orderkey, l_linenumber, l_partkey, CAST({_HALF_SQL} AS DOUBLE) AS prediction FROM lineitem")
def g3_score_batch(spark, sf_dir):
    """Save, register, promote, load by stage and score every line."""
    model, _ = _half_model(spark, sf_dir)
    root = scratch_path(spark, "models")
    version = register_model(model, spark, root, "half")
    transition_stage(spark, root, "half", version, "Staging")
    loaded = load_model(spark, root, "half", "Staging")
    scored = score_batch(labelled_lines(spark, sf_dir), loaded)
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "prediction")


@query("a8_model_by_stage", f"SELECT true AS same, count(*) AS rows FROM {_SPLIT_SQL} WHERE held")
def a8_model_by_stage(spark, sf_dir):
    """A saved model read back by name and stage predicts the test part as it did before."""
    model, test = _half_model(spark, sf_dir)
    root = scratch_path(spark, "models")
    transition_stage(spark, root, "half", register_model(model, spark, root, "half"), "Production")
    before = model.score(test).select(*LINE_KEYS, *LINE_TIES, F.col("prediction").alias("before"))
    loaded = load_model(spark, root, "half", "Production").score(test)
    both = loaded.join(before, [*LINE_KEYS, *LINE_TIES])
    return both.groupBy((F.col("prediction") == F.col("before")).alias("same")).agg(F.count(F.lit(1)).alias("rows"))


def linear_model(by_quantity: float, by_price: float):
    """A two-class scorer standing in for a model from outside Spark."""
    import numpy as np

    def predict(rows):
        up = 1.0 / (1.0 + np.exp(-(by_quantity * rows[:, 0] + by_price * rows[:, 1])))
        return np.stack([1.0 - up, up], axis=1)

    return predict


@query(
    "a8_foreign_by_stage",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(0.05 * l_quantity - 0.00002 * l_extendedprice > 0 AS INTEGER) AS prediction
       FROM lineitem WHERE abs(0.05 * l_quantity - 0.00002 * l_extendedprice) > 1e-9""",
)
def a8_foreign_by_stage(spark, sf_dir):
    """A foreign model registered, promoted, loaded by stage and applied to every line."""
    root = scratch_path(spark, "models")
    settings = {"by_quantity": 0.05, "by_price": -0.00002}
    foreign = ForeignModel(("l_quantity", "l_extendedprice"), f"{__name__}:linear_model", settings)
    transition_stage(spark, root, "linear", register_model(foreign, spark, root, "linear"), "Production")
    scored = load_model(spark, root, "linear", "Production").score(labelled_lines(spark, sf_dir))
    clear = F.abs(0.05 * F.col("l_quantity") - 0.00002 * F.col("l_extendedprice")) > 1e-9
    return scored.where(clear).select("l_orderkey", "l_linenumber", "l_partkey", "prediction")


@query(
    "g3_score_foreign",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              round(1 / (1 + exp(-(0.05 * l_quantity - 0.00002 * l_extendedprice))), 6) AS p_up FROM lineitem""",
)
def g3_score_foreign(spark, sf_dir):
    scored = score_foreign(labelled_lines(spark, sf_dir), ["l_quantity", "l_extendedprice"], lambda: linear_model(0.05, -0.00002))
    return scored.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("probability")[1], 6).alias("p_up")
    )


@query(
    "b10_parse_requests",
    f"""WITH b AS (SELECT event_id, {body_sql("VARCHAR")} AS body FROM events),
        p AS (SELECT event_id, CASE WHEN json_valid(body) THEN TRY_CAST(json_extract_string(body, '$.k') AS DOUBLE) END AS k FROM b)
        SELECT event_id, k, CASE WHEN k IS NULL THEN 'invalid' ELSE 'ok' END AS status FROM p""",
)
def b10_parse_requests(spark, sf_dir):
    return parse_requests(request_bodies(spark, sf_dir), ["k"]).select("event_id", "k", "status")


def _request_model(spark, sf_dir):
    """Two-class model on the request field, learned from a sample of events labelled by a threshold."""
    events = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("double").alias("k"))
    labelled = events.withColumn("target", (F.col("k") > 40).cast("int"))
    return train_binary(_fit_rows(labelled, ["event_id"]), ["k"], max_bins=128)


_SCORED_SQL = f"""WITH b AS (SELECT event_id, {body_sql("VARCHAR")} AS body FROM events),
       p AS (SELECT event_id, CASE WHEN json_valid(body) THEN TRY_CAST(json_extract_string(body, '$.k') AS DOUBLE) END AS k FROM b)
       SELECT event_id, CASE WHEN k IS NULL THEN 'invalid' ELSE 'ok' END AS status, CAST(k > 40 AS INTEGER) AS prediction FROM p"""


@query("g4_score_requests", _SCORED_SQL)
def g4_score_requests(spark, sf_dir):
    scored = score_requests(request_bodies(spark, sf_dir), ["k"], _request_model(spark, sf_dir))
    return scored.select("event_id", "status", "prediction")


@query("s2_score_stream", _SCORED_SQL)
def s2_score_stream(spark, sf_dir):
    """The same requests arriving as files."""
    source, out = scratch_path(spark, "request-files"), scratch_path(spark, "scored")
    bodies = request_bodies(spark, sf_dir)
    bodies.write.parquet(source)
    model = _request_model(spark, sf_dir)
    stream = read_request_stream(spark, source, bodies.schema)
    score_stream(stream, ["k"], model, out, scratch_path(spark, "scored-state")).awaitTermination()
    return spark.read.parquet(out).select("event_id", "status", "prediction")


def _drift_sql(size: str, reference: str, closed: str) -> str:
    return f"""
WITH ref AS (SELECT value AS x FROM events WHERE {reference}),
prod AS (SELECT time_bucket(INTERVAL '{size}', ts) AS w, value AS x FROM events),
grid AS (SELECT DISTINCT p.w, r.x FROM (SELECT DISTINCT w FROM prod) p, ref r UNION SELECT DISTINCT w, x FROM prod),
c AS (SELECT g.w, g.x, coalesce(p.n, 0) AS c2, coalesce(r.n, 0) AS c1 FROM grid g
      LEFT JOIN (SELECT w, x, count(*) AS n FROM prod GROUP BY 1, 2) p ON p.w = g.w AND p.x = g.x
      LEFT JOIN (SELECT x, count(*) AS n FROM ref GROUP BY 1) r ON r.x = g.x),
f AS (SELECT w, sum(c1) OVER o AS r1, sum(c2) OVER o AS r2, sum(c1) OVER (PARTITION BY w) AS n1,
             sum(c2) OVER (PARTITION BY w) AS n2 FROM c WINDOW o AS (PARTITION BY w ORDER BY x))
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(any_value(n2) AS BIGINT) AS n2,
       round(max(abs(r1::DOUBLE / n1 - r2::DOUBLE / n2)), 9) AS statistic
FROM f {closed} GROUP BY w"""


def _arrive(rows, time, path, files):
    """Write ``rows`` as files that arrive one after the other, in order of time."""
    edges = rows.agg(F.percentile_approx(time, [i / files for i in range(1, files)])).first()[0]
    place = sum((F.col(time) > F.lit(edge)).cast("int") for edge in edges)
    for number in range(files):
        rows.where(place == number).coalesce(1).write.mode("append").parquet(path)


def _drift_shown(tests):
    return tests.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "n2",
        F.round("statistic", 9).alias("statistic"),
    )


@query("s1_drift_by_window", _drift_sql("6 hours", "event_type = 'view'", ""))
def s1_drift_by_window(spark, sf_dir):
    """Six-hour windows of all events against the values of one event type."""
    events = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    reference = events.filter(F.col("event_type") == "view")
    return _drift_shown(ks_by_window(reference, "value", window_value_counts(events, "value", "ts", "6 hours")))


@query(
    "s1_drift_sketch",
    "SELECT strftime(time_bucket(INTERVAL '6 hours', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n2, true AS within FROM events GROUP BY 1",
)
def s1_drift_sketch(spark, sf_dir):
    """Sketched windows beside exact ones: whether the exact statistic lies within the sketch's bound."""
    events = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    reference = events.filter(F.col("event_type") == "view")
    exact = ks_by_window(reference, "value", window_value_counts(events, "value", "ts", "6 hours"))
    sketched = ks_by_window_sketched(reference, events, "value", "ts", "6 hours")
    both = sketched.join(exact.select("window_start", F.col("statistic").alias("exact")), "window_start")
    within = F.col("exact").between(F.col("statistic") - 1e-9, F.col("statistic") + F.col("error_bound") + 1e-9)
    return both.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n2", within.alias("within"))


@query(
    "s1_drift_stream",
    _drift_sql(
        "1 day",
        "event_type = 'view'",
        "WHERE w + INTERVAL '1 day' <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '15 minutes' FROM events)",
    ),
)
def s1_drift_stream(spark, sf_dir):
    """Daily windows of a stream of several files, one per trigger; a window is tested once the watermark has passed it."""
    source, out = scratch_path(spark, "event-files"), scratch_path(spark, "drift")
    events = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    _arrive(events, "ts", source, 4)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    reference = events.filter(F.col("event_type") == "view")
    drift_stream(stream, reference, "value", "ts", out, scratch_path(spark, "drift-state"), "1 day").awaitTermination()
    schema = T.StructType(
        [
            T.StructField("window_start", T.TimestampType()),
            T.StructField("n2", T.LongType()),
            T.StructField("statistic", T.DoubleType()),
        ]
    )
    return _drift_shown(spark.read.schema(schema).parquet(f"{out}/batch=*"))


# predictions of events; the truth comes up to an hour and a half later, and for some never
_TRUTH = {"prediction": "IF(value > 40, 1, 0)", "actual": "IF(value + event_id % 7 > 43, 1, 0)", "delay": "event_id % 90", "told": "event_id % 11 <> 0"}


@query(
    "k1_quality_stream",
    f"""WITH p AS (SELECT time_bucket(INTERVAL '6 hours', ts) AS w, {_TRUTH['prediction']} AS prediction,
                          CASE WHEN {_TRUTH['told']} AND {_TRUTH['delay']} <= 60 THEN {_TRUTH['actual']} END AS actual FROM events)
        SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS rows, count(*) FILTER (actual IS NULL) AS untold,
               count(*) FILTER (actual = prediction) AS "right",
               round(count(*) FILTER (actual = prediction)::DOUBLE / nullif(count(actual), 0), 9) AS accuracy
        FROM p GROUP BY w""",
)
def k1_quality_stream(spark, sf_dir):
    """Quality per six-hour window of predictions joined with late truth, both as streams of several files."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    predicted = events.select("event_id", "ts", F.expr(_TRUTH["prediction"]).alias("prediction"))
    late = F.expr(f"ts + make_interval(0, 0, 0, 0, 0, {_TRUTH['delay']}, 0)")
    truth = events.where(_TRUTH["told"]).select("event_id", late.alias("known_at"), F.expr(_TRUTH["actual"]).alias("actual"))
    paths = [scratch_path(spark, n) for n in ("prediction-files", "truth-files")]
    # a last row of either kind, two days on, lets every window before it close
    end = events.agg(F.max("ts") + F.expr("INTERVAL 2 DAYS")).first()[0]
    sides = []
    for path, rows, time in ((paths[0], predicted, "ts"), (paths[1], truth, "known_at")):
        _arrive(rows, time, path, 3)
        given = {"event_id": F.lit(-1), time: F.lit(end)}
        last = spark.range(1).select(*[given.get(n, F.lit(0)).cast(t).alias(n) for n, t in rows.dtypes])
        last.coalesce(1).write.mode("append").parquet(path)
        sides.append(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path))
    out = scratch_path(spark, "quality")
    quality_stream(*sides, "event_id", "actual", "ts", "known_at", out, scratch_path(spark, "quality-state"), "6 hours").awaitTermination()
    counts = spark.read.schema("window_start timestamp, actual int, prediction int, rows long").parquet(out)
    closed = quality_by_window(counts, "actual").where(F.col("window_start") < F.lit(end) - F.expr("INTERVAL 1 DAY"))
    return closed.withColumns(
        {"window_start": F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"), "accuracy": F.round("accuracy", 9)}
    )


_EARLY = "event_id <= (SELECT median(event_id) FROM events)"


@query(
    "s2_promotion_stream",
    f"""WITH b AS (SELECT event_id, {body_sql("VARCHAR")} AS body, {_EARLY} AS early FROM events),
        p AS (SELECT event_id, early, CASE WHEN json_valid(body) THEN TRY_CAST(json_extract_string(body, '$.k') AS DOUBLE) END AS k FROM b)
        SELECT event_id, CASE WHEN k IS NULL THEN 'invalid' ELSE 'ok' END AS status,
               CASE WHEN early THEN CAST(k > 0 AS INTEGER) ELSE CAST(k < 0 AS INTEGER) END AS prediction,
               CASE WHEN early THEN 1 ELSE 2 END AS model_version FROM p""",
)
def s2_promotion_stream(spark, sf_dir):
    """A version promoted between two files scores the second only; the stream runs on, and a last run adds nothing."""
    events = table(spark, sf_dir, "events")
    early = F.col("event_id") <= events.agg(F.median("event_id")).scalar()
    bodies = request_bodies(spark, sf_dir)
    root, source, out, state = (scratch_path(spark, n) for n in ("models", "request-files", "scored", "scored-state"))

    def arrive_and_score(rows, promoted):
        model = ForeignModel(("k", "k"), f"{__name__}:linear_model", {"by_quantity": promoted, "by_price": 0.0})
        transition_stage(spark, root, "sign", register_model(model, spark, root, "sign"), "Production")
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = read_request_stream(spark, source, bodies.schema, 1)
        score_stream_by_stage(stream, ["k"], root, "sign", "Production", out, state).awaitTermination()

    arrive_and_score(bodies.where(early), 1.0)
    arrive_and_score(bodies.where(~early), -1.0)
    arrive_and_score(bodies.limit(0), 0.0)
    scored = spark.read.schema(f"{_ddl(bodies)}, k double, status string, prediction int, model_version long").parquet(f"{out}/batch=*")
    return scored.select("event_id", "status", "prediction", "model_version")


def _ddl(df):
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


@query("s3_request_totals", "SELECT event_type, count(*) AS requests FROM events GROUP BY 1")
def s3_request_totals(spark, sf_dir):
    return W.request_totals(table(spark, sf_dir, "events"), "event_type")


# seconds since 1970 of a timestamp without zone
_EPOCH = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
_BOUNDS = [1, 5, 10, 50, 100]


@query(
    "s3_latency_histogram",
    " UNION ALL ".join(
        f"SELECT event_type, '{b}' AS le, count(*) FILTER (WHERE value <= {b}) AS requests FROM events GROUP BY 1"
        for b in _BOUNDS
    )
    + " UNION ALL SELECT event_type, '+Inf', count(value) FROM events GROUP BY 1",
)
def s3_latency_histogram(spark, sf_dir):
    return W.latency_histogram(table(spark, sf_dir, "events"), "event_type", "value", _BOUNDS)


@query(
    "s3_in_progress",
    """WITH c AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS "at", 1 AS change FROM events
                  UNION ALL SELECT event_type, CAST(floor(epoch(ts)) + floor(value * 60) AS BIGINT), -1 FROM events),
       g AS (SELECT event_type, "at", sum(change) AS change FROM c GROUP BY 1, 2)
       SELECT event_type, "at", CAST(sum(change) OVER (PARTITION BY event_type ORDER BY "at") AS BIGINT) AS in_progress FROM g""",
)
def s3_in_progress(spark, sf_dir):
    """Each event is open for as many minutes as its value."""
    start = F.expr(_EPOCH)
    log = table(spark, sf_dir, "events").select(
        "event_type", start.alias("start"), (start + F.floor(F.col("value") * 60)).alias("end")
    )
    return W.in_progress(log, "event_type", "start", "end")


# every tenth request never ends; the others last as many minutes as their value
_ENDS = "event_id % 10 <> 0"


@query(
    "s3_gauges_stream",
    f"""WITH g AS (SELECT event_type AS kind, count(*) AS opened, count(*) FILTER ({_ENDS}) AS ended,
                          {", ".join(f"count(*) FILTER ({_ENDS} AND floor(value * 60) <= {60 * b}) AS le_{i}" for i, b in enumerate(_BOUNDS))}
                   FROM events GROUP BY 1)
        SELECT concat(kind, '_in_progress') AS metric, (opened - ended)::DOUBLE AS value FROM g
        UNION ALL SELECT concat(kind, '_requests_total'), opened FROM g UNION ALL SELECT concat(kind, '_expired_total'), 0 FROM g
        UNION ALL SELECT concat(kind, '_latency_le_inf'), ended FROM g
        {" ".join(f"UNION ALL SELECT concat(kind, '_latency_le_{60 * b}'), le_{i} FROM g" for i, b in enumerate(_BOUNDS))}""",
)
def s3_gauges_stream(spark, sf_dir):
    """Starts and ends of requests as a stream of several files; the gauges after the last."""
    events = table(spark, sf_dir, "events").withColumn("start", F.date_trunc("second", F.col("ts").cast("timestamp")))
    last = F.timestamp_seconds(F.unix_seconds("start") + F.floor(F.col("value") * 60))
    both = F.array(
        F.struct(F.lit("start").alias("event"), F.col("start").alias("at")),
        F.struct(F.lit("end").alias("event"), F.when(F.expr(_ENDS), last).alias("at")),
    )
    rows = events.select("event_id", "event_type", F.inline(both)).where("at IS NOT NULL")
    source, gauges_path = scratch_path(spark, "request-events"), scratch_path(spark, "request-gauges")
    _arrive(rows, "at", source, 3)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    gauge_stream(
        stream, "event_id", "event", "event_type", "at", [60 * b for b in _BOUNDS], "requests",
        scratch_path(spark, "request-counts"), gauges_path, scratch_path(spark, "request-state"), timeout=10**9,
    ).awaitTermination()
    return read_gauges(spark, gauges_path).select("metric", "value")


@query(
    "k2_alert_stream",
    """WITH g AS (SELECT event_type AS job, epoch_us(ts) AS "at", value, value > 60 AS past,
                         row_number() OVER w AS place FROM events WHERE value IS NOT NULL WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
       s AS (SELECT *, place - coalesce(max(CASE WHEN NOT past THEN place END) OVER (PARTITION BY job ORDER BY place), 0) AS streak,
                    coalesce(max(CASE WHEN NOT past THEN place END) OVER (PARTITION BY job ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM g)
       SELECT job, '_value above 60' AS rule, min("at") FILTER (past AND streak = 3) AS opened_us,
              max("at") FILTER (NOT past) AS resolved_us, count(*) FILTER (past) AS observations, max(value) FILTER (past) AS worst
       FROM s GROUP BY job, island HAVING min("at") FILTER (past AND streak = 3) IS NOT NULL""",
)
def k2_alert_stream(spark, sf_dir):
    """Every event as an observation of its type's gauge, as a stream of several files; the alerts after the last."""
    history = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("job"), F.concat("event_type", F.lit("_value")).alias("metric"), F.col("ts").cast("timestamp").alias("at"), "value"
    )
    source, out = scratch_path(spark, "gauge-files"), scratch_path(spark, "alert-changes")
    _arrive(history, "at", source, 3)
    # a last observation of another gauge, a day on, lets the watermark pass all others
    end = history.agg(F.max("at") + F.expr("INTERVAL 1 DAY")).first()[0]
    last = spark.range(1).select(F.lit("end").alias("job"), F.lit("end_value").alias("metric"), F.lit(end).alias("at"), F.lit(0.0).alias("value"))
    last.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(history.schema).option("maxFilesPerTrigger", 1).parquet(source)
    alert_stream(stream, {"_value": ("above", 60)}, out, scratch_path(spark, "alert-state"), hold=3).awaitTermination()
    schema = "job string, metric string, rule string, alert long, opened_at timestamp, resolved_at timestamp, observations long, worst double"
    latest = latest_alerts(spark.read.schema(schema).parquet(f"{out}/batch=*"))
    times = (F.unix_micros(c).alias(c.replace("_at", "_us")) for c in ("opened_at", "resolved_at"))
    return latest.select("job", "rule", *times, "observations", "worst")


@query(
    "s4_request_rate_5m",
    """WITH s AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s, count(*) AS n FROM events GROUP BY 1, 2),
       t AS (SELECT event_type, epoch_s, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY epoch_s
                    RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS BIGINT) AS "trailing" FROM s)
       SELECT event_type, epoch_s, "trailing", round("trailing" / 300.0::DOUBLE, 8) AS rate FROM t""",
)
def s4_request_rate_5m(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        "event_type", F.expr(_EPOCH).alias("epoch_s")
    )
    return W.trailing_rate(log, "event_type", "epoch_s").withColumn("rate", F.round("rate", 8))

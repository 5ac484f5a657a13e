"""Queries on drift, model quality, decisions, registry and run tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import decisions as D
from tidemark.operators import drift as K
from tidemark.operators import evaluation as E
from tidemark.operators import registry as R
from tidemark.operators.splits import sample_exact
from tidemark.plans.catalog import query, table
from tidemark.plans.inputs import (
    FEATURES,
    LINE_KEYS,
    LINE_TIES,
    REGISTRY_SQL,
    labelled_lines,
    registry_events,
    run_metrics,
)
from tidemark.session import scratch_path
from tidemark.sources.metrics import (
    append_params,
    log_metrics,
    push_gauges,
    read_gauges,
    read_metrics,
    read_params,
)

_KS_SQL = """
c AS (SELECT feature, x, sum(one) AS c1, sum(two) AS c2 FROM l GROUP BY 1, 2),
r AS (SELECT feature, sum(c1) OVER w AS r1, sum(c2) OVER w AS r2, sum(c1) OVER (PARTITION BY feature) AS n1,
             sum(c2) OVER (PARTITION BY feature) AS n2 FROM c WINDOW w AS (PARTITION BY feature ORDER BY x)),
k AS (SELECT feature, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2,
             max(abs(r1::DOUBLE / n1 - r2::DOUBLE / n2)) AS d FROM r GROUP BY 1, 2, 3)
"""


def _long_sql(source: str, one: str, two: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS x, {one} AS one, {two} AS two FROM {source}" for f in FEATURES
    )


_STATUS_SQL = (
    "WITH l AS ("
    + _long_sql(
        "lineitem",
        "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END",
        "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END",
    )
    + "),"
    + _KS_SQL
)


def _by_status(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*FEATURES, "l_linestatus")
    return lines.filter(F.col("l_linestatus") == "O"), lines.filter(F.col("l_linestatus") == "F")


@query("e5_ks_statistic", _STATUS_SQL + "SELECT feature, n1, n2, round(d, 9) AS statistic FROM k")
def e5_ks_statistic(spark, sf_dir):
    """Open against finished lines, all four features."""
    found = K.ks_statistic(*_by_status(spark, sf_dir), FEATURES)
    return found.withColumn("statistic", F.round("statistic", 9))


@query(
    "e6_ks_pvalue",
    _STATUS_SQL
    + """, z AS (SELECT feature, d, round(n1::DOUBLE * n2 / (n1 + n2)) AS n FROM k),
    s AS (SELECT feature, sqrt(n) * d + 1 / (6 * sqrt(n)) + (sqrt(n) * d - 1) / (4 * n) AS x FROM z)
    SELECT feature, round(CASE WHEN any_value(x) < 0.2 THEN 1.0 ELSE
        least(1.0, 2 * sum(CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * i * i * x * x))) END, 6) AS p_value
    FROM s, generate_series(1, 100) t(i) GROUP BY feature""",
)
def e6_ks_pvalue(spark, sf_dir):
    """Samples beyond 10,000 rows, so the limiting law applies."""
    found = K.drift_test(*_by_status(spark, sf_dir), FEATURES)
    return found.select("feature", F.round("p_value", 6).alias("p_value"))


@query(
    "e6_small_pvalue",
    """SELECT o_custkey, round(-(ln(2) + lgamma(k + 1) + lgamma(k + 2) - lgamma(2 * k + 2)) / ln(10), 6) AS minus_log10_p, 'exact' AS method
       FROM (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1) WHERE k > 1""",
)
def e6_small_pvalue(spark, sf_dir):
    """Disjoint samples of k and k + 1 values per customer: 2 of C(2k + 1, k) paths are as extreme."""
    sizes = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n1")).where("n1 > 1")
    tests = K.with_p_value(sizes.withColumns({"n2": F.col("n1") + 1, "statistic": F.lit(1.0)}))
    return tests.select("o_custkey", F.round(-F.log10("p_value"), 6).alias("minus_log10_p"), "method")


def _sample_sql(seed: int) -> str:
    return f"""SELECT * FROM lineitem ORDER BY md5(concat_ws('|', '{seed}', l_orderkey, l_linenumber, l_partkey, l_suppkey)),
               l_shipdate, l_extendedprice LIMIT 50"""


@query(
    "e6_drift_of_samples",
    f"WITH a AS ({_sample_sql(42)}), b AS ({_sample_sql(1)}), l AS ("
    + _long_sql("a", "1", "0")
    + " UNION ALL "
    + _long_sql("b", "0", "1")
    + "),"
    + _KS_SQL
    + """, h AS (SELECT feature, d, CAST(round(d * 50) AS BIGINT) AS h FROM k)
    SELECT feature, round(any_value(d), 9) AS statistic, round(least(1.0, 2 * sum(CASE WHEN i * h > 50 THEN 0 ELSE
        CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END
        * exp(2 * lgamma(51) - lgamma(51 - least(i * h, 50)) - lgamma(51 + least(i * h, 50))) END)), 6) AS p_value
    FROM h, generate_series(1, 50) t(i) GROUP BY feature""",
)
def e6_drift_of_samples(spark, sf_dir):
    """The monitoring job's test: two seeded samples of 50, exact p-value."""
    rows = labelled_lines(spark, sf_dir)
    samples = [sample_exact(rows, 50, LINE_KEYS, seed, LINE_TIES) for seed in (42, 1)]
    return K.drift_test(*samples, FEATURES).select(
        "feature", F.round("statistic", 9).alias("statistic"), F.round("p_value", 6).alias("p_value")
    )


@query(
    "e7_accuracy",
    """SELECT l_linestatus, round(avg(CASE WHEN CASE WHEN l_quantity <= 17 THEN 'A' WHEN l_quantity <= 34 THEN 'N' ELSE 'R' END
              = l_returnflag THEN 1.0 ELSE 0.0 END), 8) AS accuracy FROM lineitem GROUP BY 1""",
)
def e7_accuracy(spark, sf_dir):
    guess = F.when(F.col("l_quantity") <= 17, "A").when(F.col("l_quantity") <= 34, "N").otherwise("R")
    scored = table(spark, sf_dir, "lineitem").select("l_linestatus", "l_returnflag", guess.alias("prediction"))
    return E.accuracy(scored, "l_returnflag", by=["l_linestatus"]).withColumn("accuracy", F.round("accuracy", 8))


@query(
    "e8_log_loss",
    """WITH s AS (SELECT label, list_transform(embedding, lambda x: exp(x::DOUBLE)) AS e FROM embeddings)
       SELECT round(-avg(ln(greatest(e[label + 1] / list_sum(e), 1e-15))), 6) AS log_loss FROM s""",
)
def e8_log_loss(spark, sf_dir):
    """Softmax of the vector's elements as class probabilities."""
    exps = F.transform("embedding", lambda v: F.exp(v.cast("double")))
    scores = table(spark, sf_dir, "embeddings").select("label", exps.alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda a, v: a + v)
    scored = scores.select("label", F.transform("e", lambda v: v / total).alias("probability"))
    return E.log_loss(scored, "label").withColumn("log_loss", F.round("log_loss", 6))


@query(
    "e8_log_loss_missing",
    """SELECT round(-avg(ln(CASE WHEN event_id % 3 = 0 OR event_id % 5 = 0 THEN NULL WHEN event_type = 'purchase' THEN p ELSE 1 - p END)), 6) AS log_loss,
              round(-avg(ln(CASE WHEN event_id % 3 = 0 OR event_id % 5 = 0 THEN NULL WHEN event_type = 'purchase' THEN p ELSE 1 - p END)), 6) AS binary_log_loss
       FROM (SELECT event_id, event_type, value / (value + 100) AS p FROM events)""",
)
def e8_log_loss_missing(spark, sf_dir):
    """Rows without a label or a probability are left out of both losses."""
    p = F.col("value") / (F.col("value") + 100)
    label = F.when(F.col("event_id") % 3 != 0, (F.col("event_type") == "purchase").cast("int"))
    known = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).when(F.col("event_id") % 5 != 0, p)
    rows = table(spark, sf_dir, "events").select(label.alias("target"), known.alias("p"))
    both = rows.select("target", "p", F.array(1 - F.col("p"), "p").alias("probability"))
    multi = E.log_loss(both).select(F.round("log_loss", 6).alias("log_loss"))
    return multi.withColumn("binary_log_loss", F.round(E.binary_log_loss(both, probability="p").scalar(), 6))


@query(
    "e8_binary_log_loss",
    """SELECT round(-avg(CASE WHEN event_type = 'purchase' THEN ln(p) ELSE ln(1 - p) END), 6) AS log_loss
       FROM (SELECT event_type, value / (value + 100) AS p FROM events)""",
)
def e8_binary_log_loss(spark, sf_dir):
    scored = table(spark, sf_dir, "events").select(
        (F.col("event_type") == "purchase").cast("int").alias("target"),
        (F.col("value") / (F.col("value") + 100)).alias("probability"),
    )
    return E.binary_log_loss(scored).withColumn("log_loss", F.round("log_loss", 6))


@query(
    "f1_argmax_class",
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS class FROM embeddings",
)
def f1_argmax_class(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", D.argmax(F.col("embedding")).alias("class"))


@query("f2_best_value", "SELECT vec_id, round(list_max(embedding)::DOUBLE, 6) AS best FROM embeddings")
def f2_best_value(spark, sf_dir):
    best = D.best_value(F.col("embedding")).cast("double")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(best, 6).alias("best"))


@query(
    "f6_replace_element",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda v: v::DOUBLE)) - embedding[label + 1]::DOUBLE + 9, 4) AS total FROM embeddings""",
)
def f6_replace_element(spark, sf_dir):
    """The element at the label's place becomes 9; the elements are summed to show it."""
    doubles = F.transform("embedding", lambda v: v.cast("double"))
    replaced = D.replace_element(doubles, F.col("label"), F.lit(9.0))
    total = F.aggregate(replaced, F.lit(0.0), lambda a, v: a + v)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(total, 4).alias("total"))


@query(
    "f3_binary_decision",
    "SELECT event_id, CAST(value / (value + 30) > 0.5 AS INTEGER) AS prediction FROM events",
)
def f3_binary_decision(spark, sf_dir):
    probability = F.col("value") / (F.col("value") + 30)
    return table(spark, sf_dir, "events").select("event_id", D.binary_decision(probability).alias("prediction"))


@query(
    "f3_missing_probability",
    """SELECT event_id, CAST(CASE WHEN event_type IN ('click', 'error') THEN 0 ELSE CAST(value / (value + 30) > 0.5 AS INTEGER) END AS INTEGER)
       AS prediction FROM events""",
)
def f3_missing_probability(spark, sf_dir):
    """NaN and null probabilities decide 0."""
    given = F.col("value") / (F.col("value") + 30)
    probability = F.when(F.col("event_type") == "click", float("nan")).when(F.col("event_type") != "error", given)
    return table(spark, sf_dir, "events").select("event_id", D.binary_decision(probability).alias("prediction"))


@query(
    "f4_missing_accuracy",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'error') THEN 'artifact_only' WHEN value / 40 >= 0.52 THEN 'register'
       ELSE 'artifact_only' END AS decision FROM events""",
)
def f4_missing_accuracy(spark, sf_dir):
    """NaN and null accuracies are not registered."""
    accuracy = F.when(F.col("event_type") == "click", float("nan")).when(F.col("event_type") != "error", F.col("value") / 40)
    return table(spark, sf_dir, "events").select("event_id", D.registration_gate(accuracy).alias("decision"))


@query(
    "f4_gate",
    """SELECT run_id, CASE WHEN accuracy >= 0.52 THEN 'register' ELSE 'artifact_only' END AS decision
       FROM (SELECT user_id AS run_id, avg(CASE WHEN value > 19.5 THEN 1.0 ELSE 0.0 END) AS accuracy FROM events GROUP BY 1)""",
)
def f4_gate(spark, sf_dir):
    runs = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("run_id"))
        .agg(F.avg((F.col("value") > 19.5).cast("int")).alias("accuracy"))
    )
    return E.gate_runs(runs).select("run_id", "decision")


@query(
    "f5_drift_flag",
    "SELECT event_id, coalesce(CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'error' THEN NULL "
    "ELSE value / 1000 END < 0.05, false) AS drifted FROM events",
)
def f5_drift_flag(spark, sf_dir):
    """Missing p-values, null or NaN, raise no flag."""
    p = F.when(F.col("event_type") == "error", F.lit(float("nan"))).when(
        F.col("event_type") != "click", F.col("value") / 1000
    )
    return table(spark, sf_dir, "events").select("event_id", D.drift_flag(p).alias("drifted"))


_STATE_SQL = f"""
SELECT name, version, arg_max(stage, event_seq) AS stage, max(event_seq) AS event_seq
FROM ({REGISTRY_SQL}) GROUP BY name, version
"""


@query("r2_stage_state", _STATE_SQL)
def r2_stage_state(spark, sf_dir):
    return R.stage_state(registry_events(spark, sf_dir))


@query(
    "r1_latest_in_stage",
    f"""SELECT name, stage, max(version) AS version, arg_max(event_seq, version) AS event_seq
        FROM ({_STATE_SQL}) WHERE stage = 'Staging' GROUP BY 1, 2""",
)
def r1_latest_in_stage(spark, sf_dir):
    return R.latest_in_stage(registry_events(spark, sf_dir), "Staging")


@query(
    "r3_register",
    """SELECT name, event_seq, 5 + row_number() OVER (PARTITION BY name ORDER BY event_seq) AS version, 'None' AS stage
       FROM (SELECT event_type AS name, event_id AS event_seq FROM events)""",
)
def r3_register(spark, sf_dir):
    """Every event registers a version of a busy model that already has five."""
    events = table(spark, sf_dir, "events")
    new = events.select(F.col("event_type").alias("name"), F.col("event_id").alias("event_seq"))
    existing = new.select("name").distinct().withColumn("version", F.lit(5).cast("bigint"))
    return R.register(new, existing)


@query("r3_next_version", f"SELECT name, max(version) + 1 AS next_version FROM ({REGISTRY_SQL}) GROUP BY 1")
def r3_next_version(spark, sf_dir):
    return R.next_versions(registry_events(spark, sf_dir))


@query(
    "r4_log_metrics",
    """SELECT concat('run_', CAST(user_id AS VARCHAR)) AS run_id, event_type AS key, event_id AS step, value FROM events
       UNION ALL
       SELECT concat('run_', CAST(user_id AS VARCHAR)), 'events', NULL, CAST(count(*) AS DOUBLE) FROM events GROUP BY user_id""",
)
def r4_log_metrics(spark, sf_dir):
    """Two appends, with and without steps."""
    path = scratch_path(spark, "run-metrics")
    metrics = run_metrics(spark, sf_dir)
    log_metrics(metrics, path)
    counts = metrics.groupBy("run_id").agg(F.count(F.lit(1)).alias("value"))
    log_metrics(counts.withColumn("key", F.lit("events")), path)
    return read_metrics(spark, path).select("run_id", "key", "step", "value")


@query(
    "r4_log_params",
    """SELECT concat('run_', CAST(user_id AS VARCHAR)) AS run_id, p.key,
              CASE p.key WHEN 'events' THEN CAST(count(*) AS VARCHAR) ELSE min(event_type) END AS value
       FROM events, (VALUES ('events'), ('first_type')) p(key) GROUP BY 1, 2""",
)
def r4_log_params(spark, sf_dir):
    """Two parameters of every run."""
    path = scratch_path(spark, "run-params")
    per_run = run_metrics(spark, sf_dir).groupBy("run_id").agg(
        F.count(F.lit(1)).cast("string").alias("events"), F.min("key").alias("first_type")
    )
    append_params(per_run.unpivot("run_id", ["events", "first_type"], "key", "value"), path)
    return read_params(spark, path)


@query(
    "r2_stage_transition",
    f"""SELECT name, version, CASE WHEN stage = 'Staging' THEN 'Production' ELSE stage END AS stage FROM ({_STATE_SQL})""",
)
def r2_stage_transition(spark, sf_dir):
    """Every version now in Staging moves to Production; the state is read back from all events."""
    events = registry_events(spark, sf_dir)
    staged = R.stage_state(events).filter(F.col("stage") == "Staging")
    newest = events.agg(F.max("event_seq")).scalar()
    moved = R.transition(staged, "Production", newest + 1)
    return R.stage_state(events.unionByName(moved)).select("name", "version", "stage")


_KEYS = ["click", "error", "purchase", "signup", "view"]


@query(
    "r5_compare_runs",
    "SELECT concat('run_', CAST(user_id AS VARCHAR)) AS run_id, "
    + ", ".join(f"arg_max(value, event_id) FILTER (WHERE event_type = '{k}') AS {k}" for k in _KEYS)
    + " FROM events GROUP BY 1",
)
def r5_compare_runs(spark, sf_dir):
    return R.compare_runs(run_metrics(spark, sf_dir), _KEYS)


@query(
    "r6_model_ready",
    f"""SELECT 'model_8' AS name, s.stage, count(v.name) > 0 AS ready
        FROM (VALUES ('Production'), ('Retired')) s(stage)
        LEFT JOIN (SELECT * FROM ({_STATE_SQL}) WHERE name = 'model_8') v ON v.stage = s.stage GROUP BY 1, 2""",
)
def r6_model_ready(spark, sf_dir):
    events = registry_events(spark, sf_dir)
    return R.model_ready(events, "model_8", "Production").unionByName(R.model_ready(events, "model_8", "Retired"))


_TRUTH_SQL = """
WITH p AS (SELECT doc_id, CASE WHEN n_chars >= 600 THEN 1 ELSE 0 END AS prediction FROM documents),
j AS (SELECT l.quality, p.prediction FROM p JOIN labels l USING (doc_id)),
k AS (SELECT CAST(c AS INTEGER) AS class,
             sum(CASE WHEN quality = c AND prediction = c THEN 1 ELSE 0 END) AS hit,
             sum(CASE WHEN prediction = c THEN 1 ELSE 0 END) AS claimed,
             sum(CASE WHEN quality = c THEN 1 ELSE 0 END) AS actual
      FROM j, (VALUES (0), (1)) v(c) GROUP BY 1)
SELECT class, round(coalesce(hit / nullif(claimed, 0)::DOUBLE, 0), 6) AS precision,
       round(coalesce(hit / nullif(actual, 0)::DOUBLE, 0), 6) AS recall,
       round(2 * hit / (claimed + actual)::DOUBLE, 6) AS f1,
       round((SELECT avg(CASE WHEN quality = prediction THEN 1.0 ELSE 0.0 END) FROM j), 6) AS accuracy,
       round(avg(2 * hit / (claimed + actual)::DOUBLE) OVER (), 6) AS macro_f1
FROM k
"""


@query("k1_quality_from_truth", _TRUTH_SQL)
def k1_quality_from_truth(spark, sf_dir):
    """Long documents predicted to be good, against the labels."""
    predictions = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("n_chars") >= 600, 1).otherwise(0).alias("prediction")
    )
    truth = table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = E.quality_from_truth(predictions, truth, "doc_id", "quality")
    rounded = {c: F.round(c, 6) for c in ("precision", "recall", "f1", "accuracy", "macro_f1")}
    return scored.withColumns(rounded)


@query(
    "k1_quality_by_window",
    """WITH j AS (SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, CAST(event_type = 'purchase' AS INTEGER) AS label,
                         CAST(value > 30 AS INTEGER) AS prediction FROM events),
       k AS (SELECT day, c AS class, sum(CAST(label = c AND prediction = c AS INTEGER)) AS hit,
                    sum(CAST(prediction = c AS INTEGER)) AS claimed, sum(CAST(label = c AS INTEGER)) AS actual
             FROM j, (VALUES (0), (1)) v(c) GROUP BY 1, 2),
       a AS (SELECT day, avg(CAST(label = prediction AS INTEGER)) AS accuracy FROM j GROUP BY 1)
       SELECT day, CAST(class AS INTEGER) AS class, round(coalesce(hit / nullif(claimed, 0)::DOUBLE, 0), 6) AS precision,
              round(coalesce(hit / nullif(actual, 0)::DOUBLE, 0), 6) AS recall, round(2 * hit / (claimed + actual)::DOUBLE, 6) AS f1,
              round(accuracy, 6) AS accuracy, round(avg(2 * hit / (claimed + actual)::DOUBLE) OVER (PARTITION BY day), 6) AS macro_f1
       FROM k JOIN a USING (day) WHERE claimed + actual > 0""",
)
def k1_quality_by_window(spark, sf_dir):
    """Predictions of every day against truth that arrives apart."""
    events = table(spark, sf_dir, "events")
    predictions = events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), (F.col("value") > 30).cast("int").alias("prediction")
    )
    truth = events.select("event_id", (F.col("event_type") == "purchase").cast("int").alias("label"))
    scored = E.quality_from_truth(predictions, truth, "event_id", "label", by=["day"])
    return scored.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1", "accuracy", "macro_f1")})


@query(
    "k2_alerts",
    """WITH g AS (SELECT event_type AS job, concat(event_type, '_value_max') AS metric, max(value) AS value FROM events GROUP BY 1
                  UNION ALL SELECT event_type, concat(event_type, '_value_mean'), avg(value) FROM events GROUP BY 1)
       SELECT job, metric, '_value_max above 350' AS rule FROM g WHERE metric LIKE '%value_max' AND value > 350
       UNION ALL SELECT job, metric, '_value_mean below 50' FROM g WHERE metric LIKE '%value_mean' AND value < 50""",
)
def k2_alerts(spark, sf_dir):
    path = scratch_path(spark, "alert-gauges")
    per_type = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("job"))
        .agg(F.max("value").alias("value_max"), F.avg("value").alias("value_mean"))
    )
    gauges = per_type.unpivot("job", ["value_max", "value_mean"], "kind", "value")
    push_gauges(gauges.select("job", F.concat_ws("_", "job", "kind").alias("metric"), "value"), path)
    limits = {"_value_max": ("above", 350), "_value_mean": ("below", 50)}
    return E.alerts(read_gauges(spark, path), limits).select("job", "metric", "rule")


@query(
    "k2_alert_lifecycle",
    """WITH g AS (SELECT event_type AS job, event_id AS "at", value, value > 60 AS past,
                         row_number() OVER w AS place FROM events WHERE value IS NOT NULL WINDOW w AS (PARTITION BY event_type ORDER BY event_id)),
       s AS (SELECT *, place - coalesce(max(CASE WHEN NOT past THEN place END) OVER (PARTITION BY job ORDER BY place), 0) AS streak,
                    coalesce(max(CASE WHEN NOT past THEN place END) OVER (PARTITION BY job ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM g)
       SELECT job, concat(job, '_value') AS metric, '_value above 60' AS rule, min("at") FILTER (past AND streak = 3) AS opened_at,
              max("at") FILTER (NOT past) AS resolved_at, count(*) FILTER (past) AS observations, max(value) FILTER (past) AS worst
       FROM s GROUP BY job, island HAVING min("at") FILTER (past AND streak = 3) IS NOT NULL""",
)
def k2_alert_lifecycle(spark, sf_dir):
    """Every event as an observation of its type's gauge: alerts that open at the third in a row, and resolve."""
    history = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("job"), F.concat("event_type", F.lit("_value")).alias("metric"), F.col("event_id").alias("at"), "value"
    )
    return E.alert_lifecycle(history, {"_value": ("above", 60)}, hold=3)

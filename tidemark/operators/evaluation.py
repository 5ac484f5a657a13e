"""Model quality, early stopping over recorded metrics, run summaries and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import column
from tidemark.functions.decisions import MINIMUM_ACCURACY, registration_gate
from tidemark.operators.ordering import Running, lay_out

# our clipping value for log(0)
PROBABILITY_FLOOR = 1e-15


def _correct(label: str, prediction: str) -> Column:
    return F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("int")


def accuracy(df: DataFrame, label: str = "target", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose prediction equals the label."""
    return df.groupBy(*by).agg(F.avg(_correct(label, prediction)).alias("accuracy"))


def _clipped(p: Column) -> Column:
    """``p`` away from 0 and 1; null for a missing value, which ``greatest`` would skip."""
    inside = F.least(F.greatest(p, F.lit(PROBABILITY_FLOOR)), F.lit(1.0 - PROBABILITY_FLOOR))
    return F.when(p.isNotNull() & ~F.isnan(p), inside)


def log_loss(df: DataFrame, label: str = "target", probability: str = "probability") -> DataFrame:
    """Mean negative log probability of the true class; ``probability`` is an array over classes.

    Rows without a label, or without a probability for it, are left out.
    """
    p = F.get(F.col(probability), F.col(label).cast("int"))
    return df.agg((-F.avg(F.log(_clipped(p)))).alias("log_loss"))


def binary_log_loss(df: DataFrame, label: str = "target", probability: str = "probability") -> DataFrame:
    """Log loss from the probability of class 1; rows without a label or a probability are left out."""
    p = _clipped(F.col(probability).cast("double"))
    loss = F.when(F.col(label) == 1, F.log(p)).when(F.col(label).isNotNull(), F.log(1 - p))
    return df.agg((-F.avg(loss)).alias("log_loss"))


def staged_log_loss(
    staged: DataFrame, label: str = "target", margins: str = "margins", by: Sequence[str] = (), count: str | None = None
) -> DataFrame:
    """Joint log loss after each round: ``step`` from 0 and ``log_loss``, in one aggregation.

    ``margins`` holds per class (one entry for two classes) the margin after each
    round; class scores are logistic and normalised to sum to 1.  Rows without a
    label among the classes are left out.  ``count`` tells how many rows a row stands for.
    """
    ensembles, answer = F.size(margins), column(label).cast("int")

    def chance(of: Column, step: Column) -> Column:
        return 1 / (1 + F.exp(-2 * F.get(of, step)))

    def loss(step: Column) -> Column:
        one = chance(F.get(F.col(margins), F.lit(0)), step)
        binary = F.when(answer == 1, one).when(answer == 0, 1 - one)
        total = F.aggregate(margins, F.lit(0.0), lambda sum_, of: sum_ + chance(of, step))
        share = chance(F.get(F.col(margins), answer), step) / total
        return -F.log(_clipped(F.when(ensembles == 1, binary).otherwise(share)))

    steps = F.sequence(F.lit(0), F.size(F.get(F.col(margins), F.lit(0))) - 1)
    alike = F.lit(1) if count is None else column(count)
    mean = F.avg("_loss") if count is None else F.sum(F.col("_loss") * F.col("_alike")) / F.sum(F.when(F.col("_loss").isNotNull(), F.col("_alike")))
    return (
        staged.select(*by, alike.alias("_alike"), F.posexplode(F.transform(steps, loss)).alias("step", "_loss"))
        .groupBy(*by, "step")
        .agg(mean.alias("log_loss"))
    )


def early_stop_round(
    rounds: DataFrame,
    by: Sequence[str] = ("run_id",),
    step: str = "step",
    value: str = "value",
    patience: int = 10,
) -> DataFrame:
    """Best and stopping round of each run's per-round metric (smaller is better).

    Training stops at the first round ``patience`` rounds after the last
    improvement; the best round is the first minimum up to there.  A run that
    never stalls stops at its last round.
    """
    seen = lay_out(rounds, [step], by=by).with_running(
        _best_before=Running("min", F.col(value), exclusive=True)
    )
    improved = F.col(value).isNotNull() & (
        F.col("_best_before").isNull() | (F.col(value) < F.col("_best_before"))
    )
    marked = seen.with_columns(_improved=F.when(improved, F.col(step))).with_running(
        _last=Running("max", F.col("_improved"))
    )
    stalled_at = F.when(F.col(step) - F.col("_last") >= patience, F.col(step))
    # with no stall, the last improvement of all is the first minimum
    return marked.rows().groupBy(*by).agg(
        F.coalesce(F.min_by("_last", stalled_at), F.max("_improved")).alias("best_round"),
        F.coalesce(F.min(stalled_at), F.max(step)).alias("stop_round"),
    )


def gate_runs(runs: DataFrame, accuracy_column: str = "accuracy", minimum: float = MINIMUM_ACCURACY) -> DataFrame:
    """Add the registration decision to a table of runs."""
    return runs.withColumn("decision", registration_gate(F.col(accuracy_column), minimum))


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("rows"))


def quality_from_truth(
    predictions: DataFrame,
    truth: DataFrame,
    key: str,
    label: str,
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """Accuracy, macro F1 and, in one row per class, precision, recall and F1 of scored rows.
    """
    counts = confusion(predictions.join(truth, key), label, prediction, by)
    sides = F.array(
        F.struct(
            F.col(prediction).alias("class"),
            F.when(F.col(label) == F.col(prediction), F.col("rows")).otherwise(0).alias("hit"),
            F.col("rows").alias("claimed"),
            F.lit(0).cast("bigint").alias("actual"),
        ),
        F.struct(
            F.col(label).alias("class"),
            F.lit(0).cast("bigint").alias("hit"),
            F.lit(0).cast("bigint").alias("claimed"),
            F.col("rows").alias("actual"),
        ),
    )
    per_class = (
        counts.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(F.sum("hit").alias("hit"), F.sum("claimed").alias("claimed"), F.sum("actual").alias("actual"))
        .select(
            *by,
            "class",
            F.coalesce(F.try_divide("hit", "claimed"), F.lit(0.0)).alias("precision"),
            F.coalesce(F.try_divide("hit", "actual"), F.lit(0.0)).alias("recall"),
            (2 * F.col("hit") / (F.col("claimed") + F.col("actual"))).alias("f1"),
            "hit",
            "actual",
        )
    )
    overall = per_class.groupBy(*by).agg(
        (F.sum("hit") / F.sum("actual")).alias("accuracy"), F.avg("f1").alias("macro_f1")
    )
    scored = per_class.drop("hit", "actual")
    if by:
        return scored.join(overall, list(by))
    packed = overall.select(F.struct("accuracy", "macro_f1")).scalar()
    return scored.withColumns({"accuracy": packed["accuracy"], "macro_f1": packed["macro_f1"]})


def _rule(limits: dict[str, tuple[str, float]]) -> tuple[Column, Column]:
    """The rule that applies to a gauge row, and whether its value is past the limit."""
    rule, past = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for suffix, (side, limit) in limits.items():
        mine = F.col("metric").endswith(suffix)
        rule = F.when(mine, f"{suffix} {side} {limit:g}").otherwise(rule)
        past = F.when(mine, F.col("value") > limit if side == "above" else F.col("value") < limit).otherwise(past)
    return rule, past


def observations(history: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """The gauge rows that a rule applies to and that have a value, with ``_rule`` and ``_past``; batch and stream."""
    rule, past = _rule(limits)
    seen = history.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumns({"_rule": rule, "_past": past})
    return seen.where(F.col("_rule").isNotNull())


def alert_lifecycle(
    history: DataFrame, limits: dict[str, tuple[str, float]], hold: int = 1, at: str = "at", by: Sequence[str] = ("job", "metric")
) -> DataFrame:
    """Alerts over a history of gauges: ``by, rule, opened_at, resolved_at, observations, worst``.

    An alert opens at the ``hold``-th observation past its limit in a row and
    resolves at the next one that is not (null while it is open).  Missing values
    say nothing and are left out.  Streaks are found by running maxima in the
    ordered layout, so a gauge with very many observations is no single task's.
    """
    laid = lay_out(observations(history, limits), [at], by=by).with_position("_place")
    # the last observation within the limit, before and up to each
    fine = F.when(~F.col("_past"), F.col("_place"))
    streaks = laid.with_running(_fine=Running("max", fine), _before=Running("max", fine, exclusive=True)).rows()
    length = F.col("_place") - F.coalesce("_fine", F.lit(0))
    opened = F.min(F.when(F.col("_past") & (length == hold), F.col(at)))
    worst = F.when(F.first("_rule").contains(" above "), F.max(F.when(F.col("_past"), F.col("value")))).otherwise(
        F.min(F.when(F.col("_past"), F.col("value")))
    )
    return (
        streaks.groupBy(*by, F.col("_rule").alias("rule"), F.coalesce("_before", F.lit(0)).alias("_streak"))
        .agg(
            opened.alias("opened_at"),
            F.max(F.when(~F.col("_past"), F.col(at))).alias("resolved_at"),
            F.count_if("_past").alias("observations"),
            worst.alias("worst"),
        )
        .where(F.col("opened_at").isNotNull())
        .drop("_streak")
    )


def alerts(gauges: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """Gauge rows past a limit.

    ``limits`` maps a metric suffix to (``above`` or ``below``, limit), for
    example ``{"_p_value": ("below", 0.05)}``.
    """
    hit = F.lit(None).cast("string")
    for suffix, (side, limit) in limits.items():
        value = F.when(~F.isnan("value"), F.col("value"))
        past = value > limit if side == "above" else value < limit
        rule = F.lit(f"{suffix} {side} {limit:g}")
        hit = F.when(F.col("metric").endswith(suffix) & past, rule).otherwise(hit)
    return gauges.withColumn("rule", hit).filter(F.col("rule").isNotNull())

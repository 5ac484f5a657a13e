"""Two-sample Kolmogorov-Smirnov drift between a reference and a production sample.

Values are first counted per (feature, value), so repeated values collapse
before the shuffle.  The cumulative counts then come from an ordered layout,
so neither a feature with billions of distinct values nor a window holding a
third of all rows is ever sorted by one task.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import column
from tidemark.functions.decisions import DRIFT_LEVEL, drift_flag
from tidemark.functions.kolmogorov import ks_law, ks_p_value
from tidemark.operators.ordering import PART, Running, lay_out
from tidemark.session import materialise, scratch_path, scratch_scope


def _long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per (feature, value); the unpivot happens inside the scan's stage."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("feature"), column(f).cast("double").alias("x")) for f in features]
    )
    return df.select(F.inline(pairs))


def _value_counts(reference: DataFrame, production: DataFrame, features: Sequence[str]) -> DataFrame:
    sides = [
        _long(side, features).select(
            "feature",
            "x",
            F.lit(1 if first else 0).cast("bigint").alias("one"),
            F.lit(0 if first else 1).cast("bigint").alias("two"),
        )
        for side, first in ((reference, True), (production, False))
    ]
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy("feature", "x")
        .agg(F.sum("one").alias("c1"), F.sum("two").alias("c2"))
    )


def ks_statistic(reference: DataFrame, production: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, n1, n2, statistic`` with the largest gap between the two empirical CDFs.

    A missing value in a feature makes its statistic null, as does an empty side.
    """
    counts = lay_out(_value_counts(reference, production, features), ["x"], by=["feature"])
    missing = F.col("x").isNull() | F.isnan("x")
    totals = counts.df.groupBy("feature").agg(
        F.sum("c1").alias("n1"),
        F.sum("c2").alias("n2"),
        F.max(missing).alias("incomplete"),
    )
    running = counts.with_running(
        r1=Running("sum", F.col("c1")), r2=Running("sum", F.col("c2"))
    ).rows()
    gap = F.abs(F.try_divide("r1", "n1") - F.try_divide("r2", "n2"))
    # one totals row per feature named in the call
    return (
        running.join(F.broadcast(totals), "feature")
        .groupBy("feature", "n1", "n2", "incomplete")
        .agg(F.max(gap).alias("gap"))
        .select(
            "feature",
            "n1",
            "n2",
            F.when(~F.col("incomplete"), F.col("gap")).alias("statistic"),
        )
    )


def with_p_value(statistics: DataFrame, level: float = DRIFT_LEVEL, method: str = "auto") -> DataFrame:
    """Add ``p_value``, ``method`` (the law used) and ``drifted`` to rows holding ``statistic, n1, n2``."""
    sizes = F.col("n1").cast("double"), F.col("n2").cast("double")
    scored = statistics.withColumn("p_value", ks_p_value(F.col("statistic"), *sizes, method))
    return scored.withColumn("method", ks_law(*sizes, method)).withColumn("drifted", drift_flag(F.col("p_value"), level))


def drift_test(
    reference: DataFrame,
    production: DataFrame,
    features: Sequence[str],
    level: float = DRIFT_LEVEL,
    method: str = "auto",
) -> DataFrame:
    return with_p_value(ks_statistic(reference, production, features), level, method)


def drift_gauges(tests: DataFrame, job: str) -> DataFrame:
    """Two gauges per feature, ``<feature>_ks_statistic`` and ``<feature>_p_value``."""
    pairs = F.array(
        F.struct(
            F.concat("feature", F.lit("_ks_statistic")).alias("key"), F.col("statistic").alias("value")
        ),
        F.struct(F.concat("feature", F.lit("_p_value")).alias("key"), F.col("p_value").alias("value")),
    )
    return tests.select(F.inline(pairs)).select(
        F.lit(job).alias("job"),
        F.translate("key", "-", "_").alias("metric"),
        "value",
        # fixed value: the help text of a gauge
        F.concat(F.lit("Drift metric: "), F.col("key")).alias("help"),
    )


def window_value_counts(
    production: DataFrame, value: str, time: str, size: str, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per (time window, value), the small table that window tests start from."""
    return (
        production.groupBy(F.window(time, size).alias("_window"), *by, F.col(value).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("c2"))
        .select(F.col("_window.start").alias("window_start"), *by, "x", "c2")
    )


def reference_counts(reference: DataFrame, value: str) -> DataFrame:
    """Rows per value of a reference, written once, for any number of window tests."""
    ref = reference.select(F.col(value).cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    return materialise(ref.groupBy("x").agg(F.count(F.lit(1)).alias("at")), "reference-counts")


def ks_by_window(reference: DataFrame, value: str, counts: DataFrame, by: Sequence[str] = ("window_start",)) -> DataFrame:
    return ks_against_counts(reference_counts(reference, value), counts, by)


def ks_against_counts(ref_counts: DataFrame, counts: DataFrame, by: Sequence[str] = ("window_start",)) -> DataFrame:
    """Test every window of ``counts`` (``by..., x, c2``) against the whole reference.

    Between two neighbouring production values a window's CDF is flat and the
    reference CDF only rises, so the largest gap is met either at a production
    value or just below one.  Each distinct value therefore needs two reference
    counts, looked up by an equi-join; the reference is never copied per window.
    Missing values are left out.
    """
    counts = materialise(counts.filter(F.col("x").isNotNull() & ~F.isnan("x")), "window-counts")
    pooled = (
        counts.select("x", F.lit(0).cast("bigint").alias("at"))
        .distinct()
        .unionByName(ref_counts)
        .groupBy("x")
        .agg(F.sum("at").alias("at"))
    )
    ref_upto = lay_out(pooled, ["x"]).with_running(upto=Running("sum", F.col("at"))).rows()
    n1 = ref_counts.agg(F.coalesce(F.sum("at"), F.lit(0)).alias("n1")).scalar()
    located = counts.join(ref_upto, "x").select(
        *by, "x", "c2", "upto", (F.col("upto") - F.col("at")).alias("below")
    )
    return _largest_gap(located, n1, by)


def _largest_gap(located: DataFrame, n1: Column, by: Sequence[str]) -> DataFrame:
    """Per window the statistic, from values with the reference rows up to and below each."""
    running = lay_out(located, ["x"], by=by).with_running(r2=Running("sum", F.col("c2"))).rows()
    sizes = located.groupBy(*by).agg(F.sum("c2").alias("n2"))
    share, share_below = F.col("r2") / F.col("n2"), (F.col("r2") - F.col("c2")) / F.col("n2")
    # an empty reference has no CDF, so the statistic is null
    gap = F.greatest(share - F.try_divide("upto", "n1"), F.try_divide("below", "n1") - share_below)
    return (
        running.join(sizes, list(by))
        .withColumn("n1", n1)
        .groupBy(*by, "n1", "n2")
        .agg(F.max(gap).alias("statistic"))
    )


@dataclass(frozen=True)
class ReferenceSteps:
    """A reference's cumulative counts, in a table whose buckets are value ranges.

    ``bounds`` holds the least value of each range, one per layout partition.
    """

    table: str
    bounds: tuple[float, ...]
    rows: int


def reference_steps(reference: DataFrame, value: str) -> ReferenceSteps:
    """Lay a reference out once, for any number of later lookups that move none of it.

    The table is one of the application's catalog, its files lie in the scratch folder.
    """
    spark = reference.sparkSession
    name, path = f"reference_steps_{uuid.uuid4().hex}", scratch_path(reference.sparkSession, "reference-steps")
    with scratch_scope(spark):
        steps = lay_out(reference_counts(reference, value), ["x"]).with_running(upto=Running("sum", F.col("at"))).frozen()
        edges = steps.df.groupBy(PART).agg(F.min("x").alias("least"), F.max("upto").alias("upto")).orderBy(PART).collect()
        # ranges without rows are left out, so that ranges and buckets agree
        ranges = F.array(*[F.lit(r[PART]) for r in edges]).cast("array<int>")
        numbered = steps.df.select((F.array_position(ranges, F.col(PART)) - 1).cast("int").alias("range"), "x", "at", "upto")
        writer = numbered.write.bucketBy(max(1, len(edges)), "range").sortBy("x")
        writer.option("path", path).format("parquet").saveAsTable(name)
    return ReferenceSteps(name, tuple(r["least"] for r in edges), edges[-1]["upto"] if edges else 0)


def _locate(wanted: pa.Table, steps: pa.Table) -> pa.Table:
    """The reference rows up to and below each wanted value of one range."""
    order = np.argsort(steps["x"].to_numpy(), kind="stable")
    x, at, upto = (steps[c].to_numpy()[order] for c in ("x", "at", "upto"))
    values = wanted["x"].to_numpy()
    place = np.searchsorted(x, values, "right")
    before = int(upto[0] - at[0]) if len(x) else 0
    found = np.where(place > 0, upto[place - 1], before) if len(x) else np.zeros(len(values), np.int64)
    equal = np.where((place > 0) & (x[place - 1] == values), at[place - 1], 0) if len(x) else np.zeros(len(values), np.int64)
    columns = {c: wanted[c] for c in wanted.column_names if c != "range"}
    return pa.table({**columns, "upto": pa.array(found, pa.int64()), "below": pa.array(found - equal, pa.int64())})


def locate(steps: ReferenceSteps, counts: DataFrame) -> DataFrame:
    """``counts`` (with ``x``) and the reference rows ``upto`` and ``below`` each value.

    Values go to the bucket of their range; the reference is read where it lies.
    """
    ranged = counts.withColumn("range", F.lit(0))
    if len(steps.bounds) > 1:
        splits = [float("-inf"), *steps.bounds[1:], float("inf")]
        found = Bucketizer(splits=splits, inputCol="x", outputCol="_range").transform(counts)
        ranged = found.withColumn("range", F.col("_range").cast("int")).drop("_range")
    schema = counts.schema.add("upto", "long").add("below", "long")
    reference = counts.sparkSession.table(steps.table)
    return ranged.groupBy("range").cogroup(reference.groupBy("range")).applyInArrow(_locate, schema)


def ks_against_steps(steps: ReferenceSteps, counts: DataFrame, by: Sequence[str] = ("window_start",)) -> DataFrame:
    """As ``ks_against_counts``, against a reference laid out before."""
    present = counts.filter(F.col("x").isNotNull() & ~F.isnan("x")).select(*by, "x", "c2")
    located = materialise(locate(steps, present), "located-windows")
    return _largest_gap(located, F.lit(steps.rows).cast("long"), by)


# a sketch tells values apart from the least to the most; those beyond fall into its outermost buckets
SKETCH_LEAST, SKETCH_MOST = 1e-9, 1e12


def value_bucket(value: Column, accuracy: float) -> Column:
    """The edge of the value's bucket in a sketch whose edges lie ``accuracy`` apart, relative to their size.

    The edges do not depend on the data, so counts by bucket can be added up from
    any parts, and there are at most ``sketch_buckets`` of them.  Larger values
    never get smaller edges; a missing value has none.
    """
    step = math.log1p(2 * accuracy / (1 - accuracy))
    x = value.cast("double")
    size = F.least(F.abs(x), F.lit(SKETCH_MOST))
    edge = F.lit(SKETCH_LEAST) * F.exp(F.ceil(F.log(F.greatest(size, F.lit(SKETCH_LEAST)) / SKETCH_LEAST) / step) * step)
    signed = F.when(size <= SKETCH_LEAST, F.lit(0.0)).otherwise(F.signum(x) * edge)
    return F.when(x.isNotNull() & ~F.isnan(x), signed)


def sketch_buckets(accuracy: float) -> int:
    """Buckets of a sketch at most, whatever the data."""
    return 2 * math.ceil(math.log(SKETCH_MOST / SKETCH_LEAST) / math.log1p(2 * accuracy / (1 - accuracy))) + 3


def with_error_bound(tests: DataFrame, ref_counts: DataFrame, counts: DataFrame, by: Sequence[str] = ("window_start",)) -> DataFrame:
    """Add ``error_bound`` to tests of sketched values: the exact statistic is at most so much larger, and never smaller.

    At bucket edges both distributions are known exactly; inside a bucket their
    distance changes by no more than the larger of the two shares in it.
    """
    heaviest = counts.groupBy(*by).agg((F.max("c2") / F.sum("c2")).alias("_heaviest"))
    of_reference = ref_counts.agg(F.max("at") / F.sum("at")).scalar()
    joined = tests.join(heaviest, list(by))
    return joined.withColumn("error_bound", F.greatest("_heaviest", of_reference)).drop("_heaviest")


def ks_by_window_sketched(
    reference: DataFrame, production: DataFrame, value: str, time: str, size: str, accuracy: float = 0.01
) -> DataFrame:
    """As ``ks_by_window``, from sketches of bounded size: ``statistic`` with its ``error_bound``."""
    known = reference_counts(reference.select(value_bucket(column(value), accuracy).alias("x")), "x")
    bucketed = production.select(F.col(time), value_bucket(column(value), accuracy).alias("_bucket"))
    counts = window_value_counts(bucketed, "_bucket", time, size).filter(F.col("x").isNotNull())
    counts = materialise(counts, "sketch-counts")
    return with_error_bound(ks_against_counts(known, counts), known, counts)

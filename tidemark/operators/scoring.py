"""Batch and request scoring."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.functions.decisions import argmax
from tidemark.operators.boosting import BoostedModel
from tidemark.operators.requests import INVALID, NO_MODEL, OK, SCORING_ERROR, parse_requests

OUTPUTS = ("class", "leftmost_probability")


@dataclass(frozen=True)
class ForeignModel:
    """A model from outside Spark: ``loader``, as ``module:function``, is called with ``settings`` in every Python worker.

    It returns a function from a (rows, features) array to a (rows, classes) array.
    """

    features: tuple[str, ...]
    loader: str
    settings: dict = field(default_factory=dict)

    def score(self, df: DataFrame) -> DataFrame:
        module, _, function = self.loader.partition(":")
        settings = self.settings

        def load() -> Callable:
            return getattr(importlib.import_module(module), function)(**settings)

        scored = score_foreign(df, self.features, load)
        return scored.withColumn("prediction", argmax(F.col("probability")))


def score_batch(df: DataFrame, model: BoostedModel | PipelineModel | ForeignModel, output: str = "class") -> DataFrame:
    """Input columns plus ``probability`` and ``prediction`` (double).

    ``output`` chooses what ``prediction`` holds: the class, or the
    probability of class 0.  A plain pipeline adds its own columns instead,
    ``prediction`` among them.
    """
    if output not in OUTPUTS:
        raise ValueError(f"output must be one of {OUTPUTS}")
    if isinstance(model, PipelineModel):
        if output != "class":
            raise ValueError("a plain pipeline has its own prediction column")
        return model.transform(df)
    scored = model.score(df)
    value = F.col("prediction") if output == "class" else F.col("probability")[0]
    return scored.withColumn("prediction", value.cast("double"))


def score_foreign(
    df: DataFrame,
    features: Sequence[str],
    make_predict: Callable,
    batch_size: int = 10_000,
    column: str = "probability",
) -> DataFrame:
    """Score with a model from outside Spark.

    ``make_predict`` loads the model once per Python worker and returns a
    function from a (rows, features) array to a (rows, classes) array.
    """
    udf = predict_batch_udf(
        make_predict,
        return_type=T.ArrayType(T.DoubleType()),
        batch_size=batch_size,
        input_tensor_shapes=[[len(features)]],
    )
    return df.withColumn(column, udf(F.array(*[C.column(f).cast("double") for f in features])))


def score_requests(
    requests: DataFrame, features: Sequence[str], model: BoostedModel | ForeignModel | None, body: str = "body"
) -> DataFrame:
    """Parse JSON requests and score the valid ones; works on batch and streaming frames.

    Adds ``status`` (``ok``, ``invalid``, ``no_model`` or ``scoring_error``) and
    ``prediction`` (null unless ``ok``).  Scoring went wrong where the model
    gives a valid request no usable probabilities.
    """
    parsed = parse_requests(requests, features, body)
    if model is None:
        refused = F.when(F.col("status") == INVALID, INVALID).otherwise(NO_MODEL)
        return parsed.withColumns({"status": refused, "prediction": F.lit(None).cast("int")})
    # placeholders let invalid rows pass the model in the same stage; their answer is dropped
    filled = parsed.withColumns(
        {f"_f_{f}": F.when(F.col("status") == OK, F.col(f)).otherwise(F.lit(0.0)) for f in features}
    ).withColumns({f"_in_{f}": F.col(f) for f in features})
    ready = filled.withColumns({f: F.col(f"_f_{f}") for f in features})
    scored = model.score(ready)
    usable = F.col("probability").isNotNull() & F.forall("probability", lambda p: p.isNotNull() & ~F.isnan(p))
    status = F.when((F.col("status") == OK) & ~F.coalesce(usable, F.lit(False)), SCORING_ERROR).otherwise(F.col("status"))
    return (
        scored.withColumn("status", status)
        .withColumn("prediction", F.when(F.col("status") == OK, argmax(F.col("probability"))))
        .withColumns({f: F.col(f"_in_{f}") for f in features})
        .drop("probability", *[f"_f_{f}" for f in features], *[f"_in_{f}" for f in features])
    )

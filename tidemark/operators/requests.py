"""Request parsing and validation on a column of JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OK = "ok"
INVALID = "invalid"
NO_MODEL = "no_model"
SCORING_ERROR = "scoring_error"

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_requests(
    df: DataFrame, fields: Sequence[str], body: str = "body", lenient: bool = True
) -> DataFrame:
    """Add one double column per required field, and ``status`` (``ok`` or ``invalid``).

    A request is invalid when it is not a JSON object, lacks a field, or holds
    a value that is not a number.  ``lenient`` accepts numbers given as text.
    """
    # read as the only element of a list: text after the object then breaks the list
    kind = "string" if lenient else "double"
    names = [f.replace("`", "``") for f in fields]
    kinds = f"array<struct<{', '.join(f'`{n}`:{kind}' for n in names)}>>"
    listed = F.from_json(F.concat(F.lit("["), F.col(body), F.lit("]")), kinds, {"allowNonNumericNumbers": "false"})
    parsed = df.withColumn("_r", F.when(F.size(listed) == 1, listed[0]))
    numbers = {}
    for f in fields:
        value = F.col("_r").getField(f)
        numbers[f] = F.when(value.rlike(_NUMBER), value.try_cast("double")) if lenient else value
    widened = parsed.withColumns(numbers)
    complete = F.lit(True)
    for n in names:
        complete = complete & F.col(f"`{n}`").isNotNull()
    return widened.withColumn("status", F.when(complete, OK).otherwise(INVALID)).drop("_r")


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid requests, and the invalid ones kept aside."""
    return parsed.filter(F.col("status") == OK), parsed.filter(F.col("status") != OK)

"""Mix sources to target weights by hash-random keys and distributed prefix sums.

Every document gets a key from a hash of its id and text.  Within a source the keys are
sorted in ranges: the key space is cut into as many equal ranges as the root of
the source's document count, which hashing fills evenly, so a source with a
third of all rows is spread over as many tasks.  Range totals and sums inside
the ranges give each document its place on the source's line of words; the
source's budget is whole passes over that line and a cut in the last one.

Defined results: a null text has size 0; a null source is a source, listed
last; a source whose documents are all empty has target 0; rows of one id, or
without an id, are spread by their texts; repeated rows are counted before they
are placed, and placed one after the other; an empty table gives an empty result;
other columns are ignored, whatever their names; very long texts count whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CLASS, fresh, text_or_empty
from tidemark.session import materialise

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_PASSES = 2
_KEY_BITS = 60


def n_words(text: str) -> Column:
    """Number of words; only the first and the last part of a split can be empty."""
    parts = F.split(text_or_empty(text), f"{SPACE_CLASS}+")
    first_empty = (F.get(parts, F.lit(0)) == "").cast("long")
    last_empty = ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")
    return F.size(parts) - first_empty - last_empty


def random_key(doc_id: str, text: str, seed: str = "") -> Column:
    """60 bits of a hash of id and text; the same in every run."""
    told = F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("\n"), F.md5(text_or_empty(text)))
    digest = F.md5(told)
    return F.conv(F.substring(digest, 1, _KEY_BITS // 4), 16, 10).cast("long")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = TOTAL_SHARE, most: int = MOST_PASSES
) -> DataFrame:
    """One row per source: documents, words, weight, target.

    Sources in order of code points take the weights in turn.  Targets are
    ``weight * level`` but at most ``most`` times the source's words, with the
    level at which they add up to ``share`` of all words: sources in order of
    the level at which they fill up are full before the first that does not.
    The windows here run over one row per source, not over documents.
    """
    sources = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    listed = sources.withColumn("place", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighted = listed.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_fill = W.orderBy(F.col("cap") / F.col("weight"), "place")
    before, everything = by_fill.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    total = share * F.sum("source_size").over(everything)
    full = F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    leveled = weighted.withColumn("level", (total - full) / open_weight)
    is_open = F.col("level") * F.col("weight") <= F.col("cap")
    first_open = F.min(
        F.when(is_open, F.struct((F.col("cap") / F.col("weight")).alias("fills"), "place", "level"))
    ).over(everything)
    target = F.least(F.col("cap").cast("double"), F.col("weight") * first_open["level"])
    return leveled.withColumn("target", F.coalesce(target, F.col("cap").cast("double"))).select(
        "source", "n_docs", "source_size", "weight", "target"
    )


def placed(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``sized`` (source, key, doc_id, size, tie) with its source's totals and ``upto``, the words up to and with it.

    Equal rows are counted first and told out at the end, so that no range holds
    many of them.  ``targets`` must be a written table: its size decides whether
    it is broadcast.
    """
    sized = sized.groupBy("source", "key", "doc_id", "size", "tie").agg(F.count("*").alias("copies"))
    ranges = F.ceil(F.sqrt("n_docs"))
    per_source = targets.withColumnRenamed("source", "target_source")
    joined = sized.join(per_source, F.col("source").eqNullSafe(F.col("target_source")), "left").drop("target_source")
    in_range = joined.withColumn("range", F.floor(F.col("key") / F.lit(float(1 << _KEY_BITS)) * ranges))
    inside = W.partitionBy("source", "range").orderBy("key", "doc_id", "size", "tie").rowsBetween(W.unboundedPreceding, 0)
    words = F.col("size") * F.col("copies")
    local = in_range.withColumn("local", F.sum(words).over(inside))
    sums = in_range.groupBy("source", "range").agg(F.sum(words).alias("range_size"))
    earlier = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("start_source"),
        F.col("range").alias("start_range"),
        F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("range_start"),
    )
    match = F.col("source").eqNullSafe(F.col("start_source")) & (F.col("range") == F.col("start_range"))
    return (
        local.join(starts, match, "left")
        .withColumn("later", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("upto", F.col("local") + F.col("range_start") - F.col("later") * F.col("size"))
        .drop("range", "local", "start_source", "start_range", "range_start", "copies", "later")
    )


def _sized(docs: DataFrame, source: str, doc_id: str, text: str, seed: str) -> DataFrame:
    """Key, size and tie-breaker of every document, written once; texts are read no second time."""
    narrow = docs.select(
        F.col(source).alias("source"),
        F.col(doc_id).alias("doc_id"),
        random_key(doc_id, text, seed).alias("key"),
        n_words(text).alias("size"),
        F.xxhash64(text).alias("tie"),
    )
    return materialise(narrow, "mix-sizes")


def mix(
    docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text", seed: str = ""
) -> DataFrame:
    """One row per document: size, its source's size and target, whole ``passes``, ``cut`` (words of a last, partial pass) and ``taken``.

    Passes and cut of a source add up to its target, rounded down to words.
    """
    sized = _sized(docs, source, doc_id, text, seed)
    rows = placed(sized, materialise(source_targets(sized), "mix-targets"))
    budget = F.floor(F.col("target")).cast("long")
    passes = F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))), F.lit(0)).cast("long")
    rest = budget - passes * F.col("source_size")
    partial = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("upto") - F.col("size"))))
    return (
        rows.withColumn("passes", passes)
        .withColumn("cut", partial.cast("long"))
        .withColumn("taken", F.col("passes") * F.col("size") + F.col("cut"))
    )


def first_words(text: Column, n: Column) -> Column:
    """``text`` up to the end of its ``n``-th word, white space as it is."""
    body = F.regexp_replace(text, f"^{SPACE_CLASS}+", "")
    parts = F.split(body, f"{SPACE_CLASS}+", n + 1)
    rest = F.when(F.size(parts) > n, F.length(F.element_at(parts, -1))).otherwise(0)
    return F.regexp_replace(F.left(body, F.length(body) - rest), f"{SPACE_CLASS}+$", "")


def mixed_documents(
    docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text", seed: str = ""
) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: one per whole pass, and the document at the cut shortened.

    Only each source's cut is joined to the documents, never their texts to
    their places: a key below the cut is in the last pass, one above is not.
    Rows that agree in key, id, size and text at the cut are all shortened.
    """
    of_source, last, at_cut, whole, words, take = (fresh(docs, n) for n in ("_source", "_last", "_cut", "_passes", "_size", "_take"))
    mixed = mix(docs, source, doc_id, text, seed)
    spot = ("key", "doc_id", "size", "tie")
    reached = F.when(F.col("cut") > 0, F.struct(*spot))
    cuts = materialise(
        mixed.groupBy(F.col("source").alias(of_source)).agg(
            F.max("passes").alias(whole), F.max_by("cut", reached).alias(at_cut), F.max(reached).alias(last)
        ),
        "mix-cuts",
    )
    here = F.struct(
        random_key(doc_id, text, seed).alias("key"), F.col(doc_id).alias("doc_id"), F.col(words).alias("size"), F.xxhash64(text).alias("tie")
    )
    joined = docs.withColumn(words, n_words(text)).join(cuts, F.col(source).eqNullSafe(F.col(of_source)), "left")
    extra = (
        F.when(F.col(words) == 0, 0)
        .when(here < F.col(last), F.col(words))
        .when(here == F.col(last), F.col(at_cut))
        .otherwise(0)
    )
    takes = F.concat(
        F.array_repeat(F.lit(-1).cast("long"), F.when(F.col(words) > 0, F.col(whole)).otherwise(0).cast("int")),
        F.when(extra == F.col(words), F.array(F.lit(-1).cast("long"))).otherwise(F.array(extra.cast("long"))),
    )
    rows = joined.withColumn(take, F.explode(F.filter(takes, lambda x: x != 0)))
    cut = F.when(F.col(take) < 0, F.col(text)).otherwise(first_words(F.col(text), F.col(take).cast("int")))
    out = [cut.alias(text) if c == text else F.length(cut).cast(kind).alias(c) if c == "n_chars" else F.col(c) for c, kind in docs.dtypes]
    return rows.where(F.col(words) > 0).select(*out)

"""Quality rules of documents, backed by verdicts on their hosts.

Every document is measured once, with built-in functions only.  Failures of each
rule are counted by host, the hosts' failure rates are shrunk towards that rule's
own empirical beta prior, and a host that fails a rule too often is rejected with
all its documents.

Defined results: a null or empty text has no words and fails; a null host is a
host of its own; repeated rows are measured and counted each; an empty table
gives an empty result; other columns are left as they are, whatever their names;
very long texts are measured whole.  Repeated windows are told apart by 64-bit
hashes of their words.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_SPACE_CLASS, SPACE_CLASS, fresh, text_or_empty
from tidemark.session import materialise

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
MOST_SYMBOLS_PERCENT = 10
MOST_DUP_LINES_PERCENT = 30
REJECTED_HOST_RATE = 0.75
# a prior stronger than this many documents says that hosts do not differ
STRONGEST_PRIOR = 1e6

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
RULES = ("short", "repeated", "symbols", "dup_lines")
# the rules that a document itself is rejected for
BASE_RULES = ("short", "repeated")


def failures(measures: str | None = None) -> dict[str, Column]:
    """Each rule's failure, from columns or the fields of a struct named as ``MEASURES``."""
    m = {n: F.col(f"{measures}.{n}" if measures else n) for n in MEASURES}
    return {
        "short": m["n_words"] < LEAST_WORDS,
        "repeated": 100 * m["n_repeat_words"] > MOST_REPEATED_PERCENT * m["n_words"],
        "symbols": 100 * m["n_symbols"] > MOST_SYMBOLS_PERCENT * m["n_words"],
        "dup_lines": 100 * m["n_dup_lines"] > MOST_DUP_LINES_PERCENT * m["n_lines"],
    }


def _pairs(hashes: str, apart: int) -> Column:
    """A hash of each entry with the one ``apart`` places on."""
    size = F.size(hashes) - apart
    paired = F.zip_with(F.slice(hashes, F.lit(1), size), F.slice(hashes, F.lit(1 + apart), size), lambda a, b: F.xxhash64(a, b))
    return F.when(size > 0, paired).otherwise(F.array().cast("array<bigint>"))


def _repeat_words(df: DataFrame, windows: str, n: str, into: str) -> DataFrame:
    """Adds the number of words lying in a window whose hash occurs twice or more.

    The hashes with their places are sorted, so equal windows are neighbours;
    the places of repeated windows are sorted again and their spans added up,
    without the overlap of each with the next.  Texts without a repeated
    window, nearly all, skip the sorting.  Each step is a column of its own:
    inside a lambda an expression would be evaluated once per element.
    """
    at, keys, places = (fresh(df, x) for x in ("_placed", "_keys", "_places"))
    has_repeat = F.size(F.array_distinct(windows)) < F.size(windows)
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    stepped = df.withColumn(at, F.when(has_repeat, placed)).withColumn(keys, F.transform(at, lambda x: x["h"]))
    same = F.transform(
        at, lambda x, k: F.when((F.get(keys, k - 1) == x["h"]) | (F.get(keys, k + 1) == x["h"]), x["i"])
    )
    stepped = stepped.withColumn(places, F.array_sort(F.filter(same, lambda i: i.isNotNull())))
    covered = F.transform(
        places, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1), F.col(n).cast("int")) - i)
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda so_far, x: so_far + x)
    return stepped.withColumn(into, F.coalesce(total, F.lit(0).cast("long"))).drop(at, keys, places)


def measured(docs: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with the struct ``into`` of ``MEASURES``, whose name must be free.

    The steps are separate projections, so that each array is computed once.  A
    window's hash is made of the hashes of its halves, three pairings for eight
    words.
    """
    named = {n: fresh(docs, f"_{n}") for n in (*MEASURES, "words", "lines", "ids", "twos", "fours", "windows")}
    body = text_or_empty(text)
    counted = (
        docs.withColumn(named["words"], F.array_remove(F.split(body, f"{SPACE_CLASS}+"), ""))
        .withColumn(named["lines"], F.filter(F.split(body, "\n"), lambda line: line.rlike(NOT_SPACE_CLASS)))
        .withColumn(named["n_words"], F.size(named["words"]).cast("long"))
        .withColumn(named["word_chars"], F.length(F.array_join(named["words"], "")).cast("long"))
        .withColumn(named["n_symbols"], (F.size(F.split(body, r"[#*$%&|<>]")) - 1).cast("long"))
        .withColumn(named["n_lines"], F.size(named["lines"]).cast("long"))
        .withColumn(named["n_dup_lines"], (F.size(named["lines"]) - F.size(F.array_distinct(named["lines"]))).cast("long"))
        .withColumn(named["ids"], F.transform(named["words"], lambda w: F.xxhash64(w)))
        .drop(named["words"], named["lines"])
        .withColumn(named["twos"], _pairs(named["ids"], 1))
        .drop(named["ids"])
        .withColumn(named["fours"], _pairs(named["twos"], 2))
        .drop(named["twos"])
        .withColumn(named["windows"], _pairs(named["fours"], 4))
        .drop(named["fours"])
    )
    repeats = _repeat_words(counted, named["windows"], named["n_words"], named["n_repeat_words"])
    struct = F.struct(*[F.col(named[m]).alias(m) for m in MEASURES])
    return repeats.withColumn(into, struct).drop(named["windows"], *[named[m] for m in MEASURES])


def host_verdicts(
    checked: DataFrame, host: str, failed: Column | Mapping[str, Column], reject_above: float = REJECTED_HOST_RATE
) -> DataFrame:
    """One row per host: its documents, the shrunk failure rate per rule, and the rules that reject it.

    A rule's prior has the overall rate as mean; its strength comes from how much
    more the hosts' rates spread than chance alone would make them (the moment
    estimate of the beta-binomial).  The rate of a host is its posterior mean.
    """
    rules = dict(failed) if isinstance(failed, Mapping) else {"rule": failed}
    counted = checked.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"), *[F.sum(c.cast("long")).alias(f"failed_{r}") for r, c in rules.items()]
    )
    hosts = materialise(counted, "quality-hosts")
    n = F.col("n_docs")
    totals = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum(n).alias("docs"),
        F.sum(n * n).alias("squares"),
        *[F.sum(f"failed_{r}").alias(f"failures_{r}") for r in rules],
        *[F.sum(F.col(f"failed_{r}") * F.col(f"failed_{r}") / n).alias(f"spread_{r}") for r in rules],
    )

    def prior(rule: str) -> Column:
        p = F.col(f"failures_{rule}") / F.col("docs")
        excess = F.try_divide(F.col(f"spread_{rule}") - F.col("docs") * p * p, p * (1 - p)) - (F.col("hosts") - 1)
        room = F.col("docs") - F.try_divide(F.col("squares"), F.col("docs")) - (F.col("hosts") - 1)
        share = F.coalesce(F.try_divide(excess, room), F.lit(0.0))
        bounded = F.least(F.lit(STRONGEST_PRIOR), F.greatest(F.lit(0.0), 1 / share - 1))
        return F.struct(p.alias("mean"), F.when(share <= 0, STRONGEST_PRIOR).otherwise(bounded).alias("strength"))

    # one row of totals beside every host: a scalar, not a product of tables
    priors = totals.select(F.struct(*[prior(r).alias(r) for r in rules])).scalar()
    rates = {r: (F.col(f"failed_{r}") + priors[r]["mean"] * priors[r]["strength"]) / (n + priors[r]["strength"]) for r in rules}
    rated = hosts.select("host", "n_docs", *[rate.alias(f"rate_{r}") for r, rate in rates.items()])
    over = [F.when(F.col(f"rate_{r}") > reject_above, r) for r in rules]
    worst = F.greatest(*[F.col(f"rate_{r}") for r in rules]) if len(rules) > 1 else F.col(f"rate_{next(iter(rules))}")
    return rated.withColumn("rejected_by", F.concat_ws(",", *over)).withColumns(
        {"rate": worst, "rejected": F.col("rejected_by") != ""}
    )


def _known_size(verdicts: DataFrame, *columns: Column) -> DataFrame:
    """Verdicts written, so that Spark knows their size: it broadcasts few and splits a hot host's rows if there are many."""
    return materialise(verdicts.select(*columns), "quality-verdicts")


def judged(
    docs: DataFrame, host: str = "source", doc_id: str = "doc_id", text: str = "text", reject_above: float = REJECTED_HOST_RATE
) -> DataFrame:
    """One row per document: its id, host, measures, ``base_failed``, ``kept``, and whether and by which rules its host is rejected.

    The measures are written once, narrow; counting and joining read them.
    """
    narrow = measured(docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text")))
    checked = materialise(narrow.select("doc_id", "host", "quality.*"), "quality-measures")
    rules = failures()
    verdicts = _known_size(
        host_verdicts(checked, "host", rules, reject_above),
        F.col("host").alias("verdict_host"),
        F.col("rejected").alias("host_rejected"),
        F.col("rejected_by").alias("host_rules"),
    )
    joined = checked.join(verdicts, F.col("host").eqNullSafe(F.col("verdict_host")), "left").drop("verdict_host")
    base = rules[BASE_RULES[0]] | rules[BASE_RULES[1]]
    return joined.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def kept_documents(docs: DataFrame, host: str = "source", text: str = "text", reject_above: float = REJECTED_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that pass their rules and whose host is not rejected, unchanged.

    The documents are written once with their failures; hosts are counted from
    the narrow columns of that table, and its texts are read only to be kept.
    """
    flags, other = fresh(docs, "_quality"), fresh(docs, "_rejected_host")
    rules = failures(flags)
    marked = measured(docs, text, flags).withColumn(flags, F.struct(*[c.alias(r) for r, c in rules.items()]))
    checked = materialise(marked, "quality-measured")
    failed = {r: F.col(f"{flags}.{r}") for r in RULES}
    rejected = _known_size(
        host_verdicts(checked, host, failed, reject_above).where("rejected"), F.col("host").alias(other)
    )
    passed = checked.where(~(failed[BASE_RULES[0]] | failed[BASE_RULES[1]])).drop(flags)
    return passed.join(rejected, F.col(host).eqNullSafe(F.col(other)), "left_anti")

"""Queries of the operators that work on texts and vectors in Python tasks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, near_dup, packing, quality_model, secret_scan, topk, toxicity
from tidemark.llm.catalog import query, table
from tidemark.llm.common import id_share, labelled_sample


def byte_bpe() -> Callable[[str], list[int]]:
    """The encoder of the public 50k byte-level vocabulary."""
    path = public_tokenizers.path
    return packing.encoder(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_bpe())


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", secret_scan.spans_of(F.col("text")).alias("found"))

    def joined(kinds: tuple[str, ...]):
        listed = F.filter("found", lambda s: s["kind"].isin(*kinds))
        return F.array_join(F.transform(listed, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base, every = secret_scan.KINDS[:3], secret_scan.KINDS
    return docs.select(
        "doc_id", *[number(k) for k in base], F.sha2(joined(base), 256).alias("base_sha256"), joined(every).alias("spans"), number("guess")
    )


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = id_share("doc_id", 4)
    model = language_id.fit(docs, fold != 2)
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


OP5_SQL = """
WITH points AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_dot_product(q.v, p.v) AS BIGINT) AS score
  FROM points q JOIN points p ON q.vec_id % 50 = 0 AND q.vec_id <> p.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op5_exact_topk", OP5_SQL)
def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    fold = id_share("doc_id", 5)
    model = toxicity.fit(labelled_sample(docs, labels, "toxic", fold != 0))
    return docs.select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), toxicity.scored(F.col("text"), model, spark).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    fold = id_share("doc_id", 5)
    model = quality_model.fit(labelled_sample(docs, labels, "quality", fold != 0))
    return docs.select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), quality_model.scored(F.col("text"), model, spark).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


OP10_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) >= 3 THEN list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')))
                      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles
  FROM worded
), flat AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a
), component AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, len(shingles) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN component USING (doc_id)
"""


@query("op10_near_dedup", OP10_SQL)
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)

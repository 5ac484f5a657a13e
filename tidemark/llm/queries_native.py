"""Queries of the native operators: chat formatting, source mixing, quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, mixing, quality_rules
from tidemark.llm.catalog import query, table

_PROBE = "</s>[INST] ok [/INST]"

OP1_SQL = r"""
WITH all_turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, 'messages_text' AS layout FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', 'prompt_response'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'prompt_response'
), marked AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?SYS>|/?INST\]|/?ROLE\]|\|(?:im_start|im_end|endoftext|user|assistant|system)\|>)', '\1\\\2\3', 'g'))
          + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?SYS>|/?INST\]|/?ROLE\]|\|(?:im_start|im_end|endoftext|user|assistant|system)\|>)', '\1\\\2\3', 'g'))
          + length('<s>[ROLE][/ROLE]') + length('</s>') + 2 AS chars
  FROM all_turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, min(layout) AS layout
FROM marked GROUP BY conv_id
"""


@query("op1_chat_format", OP1_SQL)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and a probe in another layout, formatted and read back."""
    records = chat.records_of_turns(table(spark, sf_dir, "conversations"))
    probe = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.to_variant_object(F.struct(F.lit(_PROBE).alias("prompt"), F.lit(_PROBE).alias("response"))).alias("record"),
    )
    output = chat.formatted(chat.canonical_turns(records.unionByName(probe)))
    read = output.select("conv_id", "layout", "formatted", chat.read_back().alias("turns"), chat.read_loss().alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "layout",
    )


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS key
  FROM documents
), sources AS (
  SELECT source, count(*) AS n_docs, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), listed AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight,
         2 * source_size AS cap, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place FROM sources
), leveled AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM sources)
             - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM listed
), water AS (
  SELECT level FROM leveled WHERE level * weight <= cap ORDER BY cap::DOUBLE / weight, place LIMIT 1
), targets AS (
  SELECT source, n_docs, source_size, least(cap::DOUBLE, weight * coalesce((SELECT level FROM water), cap::DOUBLE)) AS target FROM listed
), placed AS (
  SELECT doc_id, size, source_size, target,
         sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto,
         CAST(floor(target) AS BIGINT) AS budget
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS n FROM placed
)
SELECT doc_id, size, source_size, target,
       CAST(n * size + greatest(0, least(size, budget - n * source_size - (upto - size))) AS BIGINT) AS taken
FROM passes
"""


@query("op8_source_mix", OP8_SQL)
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH worded AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         row_number() OVER () AS row_id
  FROM documents
), windows AS (
  SELECT row_id, i, list_aggregate(words[i:i + 7], 'string_agg', ' ') AS gram
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 6)) AS i FROM worded WHERE len(words) >= 8)
), repeated AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, gram) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT row_id, count(DISTINCT i + k) AS n_repeat_words FROM repeated, range(0, 8) AS steps(k) GROUP BY row_id
), measured AS (
  SELECT doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM worded LEFT JOIN covered USING (row_id)
), failing AS (
  SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeated,
         100 * n_symbols > 10 * n_words AS symbols, 100 * n_dup_lines > 30 * n_lines AS dup_lines FROM measured
), hosts AS (
  SELECT source, place, rule, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS k
  FROM (SELECT source, unnest([1, 2, 3, 4]) AS place, unnest(['short', 'repeated', 'symbols', 'dup_lines']) AS rule,
               unnest([short, repeated, symbols, dup_lines]) AS failed FROM failing) GROUP BY ALL
), totals AS (
  SELECT rule, count(*) AS h, sum(n) AS docs, sum(k) / sum(n) AS p, sum(n * n) AS squares, sum(k * k / n) AS spread FROM hosts GROUP BY rule
), prior AS (
  SELECT rule, p, CASE WHEN share IS NULL OR share <= 0 THEN 1e6 ELSE least(1e6, greatest(0, 1 / share - 1)) END AS strength
  FROM (SELECT rule, p, (CASE WHEN p * (1 - p) > 0 THEN (spread - docs * p * p) / (p * (1 - p)) - (h - 1) END)
                        / nullif(docs - squares / docs - (h - 1), 0) AS share FROM totals)
), verdicts AS (
  SELECT source, coalesce(string_agg(rule, ',' ORDER BY place) FILTER ((k + p * strength) / (n + strength) > 0.75), '') AS host_rules
  FROM hosts JOIN prior USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeated AS base_failed,
       NOT (short OR repeated) AND host_rules = '' AS kept, host_rules <> '' AS host_rejected, host_rules
FROM failing JOIN verdicts ON failing.source IS NOT DISTINCT FROM verdicts.source
"""


@query("op9_quality_rules", OP9_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).drop("host", "n_lines")

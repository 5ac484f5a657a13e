"""Queries of page extraction, conversation repair and ranked search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import conversation_repair, lexical_search, site_tree
from tidemark.llm.catalog import query, table

# the tree itself is beyond SQL, but not its result on these tables, whose pages hold their main text in one article
OP11_SQL = r"""
WITH articles AS (
  SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?b>', '', 'g') AS body FROM pages
), pieces AS (
  SELECT page_id, url, list_filter(list_transform(string_split_regex(replace(body, '<br>', ' '), '<[^>]*>'), lambda b:
           trim(regexp_replace(replace(replace(replace(replace(replace(replace(b, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&#x27;', ''''),
                                       '&amp;', '&'), '[\x20\x09-\x0D]+', ' ', 'g'))), lambda b: b <> '') AS blocks
  FROM (SELECT page_id, url, regexp_replace(body, '&amp([^;a-z0-9=])', '&amp;\1', 'g') AS body FROM articles)
)
SELECT page_id, url, array_to_string(blocks, chr(10)) AS text, CAST(length(array_to_string(blocks, chr(10))) AS BIGINT) AS n_chars FROM pieces
"""


@query("op11_site_tree", OP11_SQL)
def op11_site_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = site_tree.extract(table(spark, sf_dir, "pages"))
    return found.select(
        "page_id", "url", F.col("main.text").alias("text"), F.col("main.n_chars").alias("n_chars")
    )


OP12_SQL = r"""
WITH RECURSIVE crcs AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(
               string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda c, b: xor(c >> 8, t[CAST(1 + (xor(c, b) & 255) AS INTEGER)])), 4294967295) % 20 AS damage
  FROM conversations, crcs
), rows_left AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed, range(0, 2) AS copies(copy) WHERE damage <> 0 AND (copy = 0 OR damage = 3)
), counted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS copy FROM rows_left
), placed AS (
  SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         coalesce(lag(role[1:1]) OVER o || role[1:1] NOT IN ('su', 'ua', 'au'), false) AS illegal,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN copy > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM counted WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), priced AS (
  SELECT conv_id, i, n, role, text, role[1:1] AS r, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS x,
         CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 ELSE 0 END AS must
  FROM placed
), back(conv_id, i, a0, a1, a2, a3, b0, b1, b2, b3) AS (
  SELECT conv_id, n + 1, 0, 0, 0, 0, 0, 4, 2, 0 FROM priced WHERE i = n
  UNION ALL
  SELECT conv_id, i, b0, b1, b2, b3, least(m0, 2 + least(m2, 2 + m3)), least(m1, 2 + least(m2, 2 + m3)), least(m2, 2 + m3), least(m3, 2 + m2)
  FROM (SELECT p.conv_id, p.i, b0, b1, b2, b3,
               least(3 + b0, must + x + 2 + b2, must + x + CASE r WHEN 's' THEN b1 WHEN 'u' THEN b2 ELSE 1000000 END) AS m0,
               least(3 + b1, must + x + 2 + b2, must + x + CASE r WHEN 'u' THEN b2 ELSE 1000000 END) AS m1,
               least(3 + b2, must + x + 2 + b3, must + x + CASE r WHEN 'a' THEN b3 ELSE 1000000 END) AS m2,
               least(3 + b3, must + x + 2 + b2, must + x + CASE r WHEN 'u' THEN b2 ELSE 1000000 END) AS m3
        FROM back JOIN priced p ON p.conv_id IS NOT DISTINCT FROM back.conv_id AND p.i = back.i - 1)
), steps AS (
  SELECT b.conv_id, b.i, s, [a0, a1, a2, a3] AS a, [b0, b1, b2, b3][s + 1] AS best, [b0, b1, b2, b3] AS b, [2, 2, 3, 2][s + 1] AS onward,
         coalesce(CASE s WHEN 0 THEN CASE r WHEN 's' THEN 1 WHEN 'u' THEN 2 END WHEN 2 THEN CASE r WHEN 'a' THEN 3 END ELSE CASE r WHEN 'u' THEN 2 END END, -1) AS keep,
         x, must, role, text, p.i IS NULL AS ended
  FROM back b CROSS JOIN range(0, 4) AS states(s) LEFT JOIN priced p ON p.conv_id IS NOT DISTINCT FROM b.conv_id AND p.i = b.i
), chosen AS (
  SELECT *, CASE WHEN ended THEN CASE WHEN s IN (1, 2) THEN 'I' ELSE '' END
                 WHEN 3 + a[s + 1] = best THEN 'D' WHEN 2 + b[onward + 1] = best THEN 'I'
                 WHEN keep >= 0 AND must + x + a[keep + 1] = best THEN 'K' ELSE 'R' END AS edit
  FROM steps
), walk(conv_id, i, s, audit, cost, told) AS (
  SELECT conv_id, CAST(1 AS BIGINT), CAST(0 AS BIGINT), '', 0, CAST([] AS VARCHAR[]) FROM priced WHERE i = 1
  UNION ALL
  SELECT w.conv_id, CASE edit WHEN 'I' THEN w.i ELSE w.i + 1 END,
         CAST(CASE edit WHEN 'D' THEN w.s WHEN 'K' THEN keep ELSE onward END AS BIGINT), audit || edit,
         cost + CASE edit WHEN 'D' THEN 3 WHEN 'I' THEN 2 WHEN 'R' THEN 2 + x ELSE x END,
         CASE edit WHEN 'D' THEN told
                   WHEN 'K' THEN list_append(told, role || ':' || text)
                   ELSE list_append(told, CASE onward WHEN 2 THEN 'user:' ELSE 'assistant:' END || CASE edit WHEN 'R' THEN text ELSE '' END) END
  FROM walk w JOIN chosen c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.i = w.i AND c.s = w.s WHERE edit <> ''
), ended AS (
  SELECT w.conv_id, audit, cost, told FROM walk w JOIN chosen c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.i = w.i AND c.s = w.s WHERE edit = ''
), figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
         count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated, count_if(illegal) AS illegal
  FROM placed GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(told, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query("op12_conversation_repair", OP12_SQL)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, lost = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.accounts(conversation_repair.edits(rows, lost=lost))


OP13_SQL = r"""
WITH worded AS (
  SELECT doc_id, row_number() OVER () AS row_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '') AS terms
  FROM documents
), totals AS (
  SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM worded WHERE len(terms) > 0
), counted AS (
  SELECT row_id, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_id, doc_id, len(terms) AS n, unnest(terms) AS term FROM worded) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals GROUP BY term, docs
), items AS (
  SELECT item_id, row_number() OVER () AS item_no, text FROM (SELECT DISTINCT item_id, text FROM benchmark)
), asked AS (
  SELECT item_no, item_id, term, count(*) AS times FROM (
    SELECT item_no, item_id, unnest(list_filter(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '')) AS term FROM items) GROUP BY ALL
), scored AS (
  SELECT item_no, item_id, row_id, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term), totals GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query("op13_lexical_search", OP13_SQL)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

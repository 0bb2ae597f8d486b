"""The registered queries of the operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlog.llm import (
    alignment,
    chat,
    decontaminate,
    divergence,
    mixing,
    neardup,
    pieces,
    quality,
    substrings,
    tokenfile,
    toxicity,
    urls,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_counts(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.duplicate_words(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archived(table(spark, sf_dir, "pages"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return index.select(*columns, "url_key", "capture_no", "position")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train_on(docs, table(spark, sf_dir, "labels")))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op9_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges trained on are given as text, ``begin-end`` with a space between."""
    turns = table(spark, sf_dir, "conversations")
    examples = chat.preference_examples(turns.withColumnRenamed("conv_id", "pair_id"), chat.answers_swapped(turns))
    for name in ("chosen_trained", "rejected_trained"):
        ranges = F.transform(name, lambda x: F.concat_ws("-", x["begin"].cast("string"), x["end"].cast("string")))
        examples = examples.withColumn(name, F.array_join(ranges, " "))
    return examples


def op10_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.written(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_mix_sources": op4_mix_sources,
    "op5_warc_index": op5_warc_index,
    "op6_toxicity": op6_toxicity,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_url_filters": op8_url_filters,
    "op9_preference_pairs": op9_preference_pairs,
    "op10_minhash_neardup": op10_minhash_neardup,
    "op11_token_ids": op11_token_ids,
    "op12_source_divergence": op12_source_divergence,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {}

ORACLES["op1_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), w AS (
  SELECT row_id, i, words[i:i + 7] AS seq FROM (SELECT row_id, words, unnest(range(1, len(words) - 6)) AS i FROM d)
), twice AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, seq) AS n FROM w) WHERE n > 1
), covered AS (
  SELECT row_id, count(DISTINCT p) AS n FROM (SELECT row_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY row_id
), m AS (
  SELECT d.doc_id, d.text, d.lines,
         len(d.words)::BIGINT AS n_words,
         length(array_to_string(d.words, ''))::BIGINT AS word_chars,
         (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(d.lines) - len(list_distinct(d.lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered c USING (row_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
            OR n_symbols * 10 > n_words * 4
            OR (length(text) - length(replace(text, '!', ''))) * 10 > n_words * 4
            OR n_dup_lines * 100 > len(lines) * 40
            OR word_chars < n_words * 2 OR word_chars > n_words * 20) AS kept
FROM m
"""

ORACLES["op4_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce('s' || source, '') || '|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER] AS w
  FROM d GROUP BY source
), capped_first AS (
  -- the capped sources are those with the least size per weight
  SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST) AS i FROM s
), levels AS (
  SELECT i, source_size, w,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM capped_first
), level AS (
  SELECT level FROM levels WHERE level * w <= 3 * source_size ORDER BY i LIMIT 1
), t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, level * w) AS target FROM s, level
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS copies FROM t
), h AS (
  SELECT source, hash, sum(size)::BIGINT AS size FROM d GROUP BY source, hash
), c AS (
  SELECT h.*, p.target - p.copies * p.source_size AS rest,
         coalesce(sum(h.size) OVER (PARTITION BY h.source ORDER BY hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM h JOIN p ON h.source IS NOT DISTINCT FROM p.source
), x AS (
  SELECT source, hash FROM c WHERE rest > 0 AND below < rest
     AND (below + size < rest OR (rest - below) * 2 >= size)
)
SELECT d.doc_id, d.size, p.source_size, p.target,
       (d.size * (p.copies + CASE WHEN x.hash IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.hash = x.hash
"""
ORACLES["op5_warc_index"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS row_id,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^#]*)', 1), '') AS authority,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^#]*)', 2), '') AS rest,
         coalesce(contains(url, '://'), false) AS has_host
  FROM pages
), b AS (
  SELECT row_id, upper(string_agg(
           ['A','B','C','D','E','F','G','H','I','J','K','L','M','N','O','P','Q','R','S','T','U','V','W','X','Y','Z',
            '2','3','4','5','6','7'][1 + ((('0x' || substr(h, 10 * g + 1, 10))::BIGINT >> (5 * k)) & 31)],
           '' ORDER BY g, k DESC)) AS digest
  FROM (SELECT row_id, sha1(html) AS h FROM p), range(4) AS gs(g), range(8) AS ks(k) GROUP BY row_id
), c AS (
  SELECT p.page_id, strlen(html)::BIGINT AS payload_bytes, digest, max(page_id) OVER (PARTITION BY digest) AS kept,
         CASE WHEN has_host THEN
           array_to_string(list_reverse(string_split(lower(split_part(regexp_replace(authority, '^.*@', ''), ':', 1)), '.')), ',')
           || ')' || CASE WHEN rest = '' THEN '/' ELSE rest END ELSE '' END AS url_key
  FROM p JOIN b USING (row_id)
)
SELECT page_id, payload_bytes, digest AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM kept THEN kept END AS refers_to,
       url_key,
       row_number() OVER (PARTITION BY url_key ORDER BY page_id NULLS FIRST) AS capture_no,
       row_number() OVER (ORDER BY url_key, page_id NULLS FIRST) - 1 AS "position"
FROM c
"""

ORACLES["op8_url_filters"] = r"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p
), v AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS ruled
  FROM r
), l AS (
  SELECT host FROM v WHERE host <> '' GROUP BY host HAVING count(*) FILTER (WHERE ruled = 'block') * 2 >= count(*)
)
SELECT page_id, v.host, path, rule,
       coalesce(ruled, CASE WHEN l.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM v LEFT JOIN l ON v.host = l.host
"""

ORACLES["op9_preference_pairs"] = r"""
WITH c AS (SELECT DISTINCT conv_id AS pair_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), last AS (
  SELECT pair_id, max(turn) AS turn, arg_max(coalesce(text, ''), turn) AS answer FROM c WHERE role = 'assistant' GROUP BY pair_id
), j AS (
  SELECT c.*, coalesce(c.role = 'assistant' AND c.turn = l.turn, false) AS swapped, coalesce(o.answer, '') AS answer
  FROM c LEFT JOIN last l ON c.pair_id = l.pair_id LEFT JOIN last o ON xor(c.pair_id, 1) = o.pair_id
), t AS (
  SELECT pair_id, turn, role, text, CASE WHEN swapped THEN answer ELSE text END AS other FROM j
), n AS (
  SELECT *, coalesce(min(CASE WHEN text IS DISTINCT FROM other THEN turn END) OVER (PARTITION BY pair_id), 1000000000) AS cut,
         '<|' || coalesce(role, 'unknown') || '|>' || chr(10) AS head, chr(10) || '<|end|>' || chr(10) AS tail
  FROM t
), s AS (
  SELECT pair_id, turn, cut, role, head,
         head || coalesce(text, '') || tail AS a, head || coalesce(other, '') || tail AS b
  FROM n
), m AS (
  SELECT *,
    sum(CASE WHEN turn >= cut THEN length(a) ELSE 0 END) OVER w AS a_end,
    sum(CASE WHEN turn >= cut THEN length(b) ELSE 0 END) OVER w AS b_end
  FROM s WINDOW w AS (PARTITION BY pair_id ORDER BY turn)
)
SELECT pair_id, count(*) FILTER (WHERE turn < cut)::INTEGER AS prompt_turns,
  coalesce(string_agg(a, '' ORDER BY turn) FILTER (WHERE turn < cut), '') AS prompt,
  coalesce(string_agg(a, '' ORDER BY turn) FILTER (WHERE turn >= cut), '') AS chosen,
  coalesce(string_agg((a_end - length(a) + length(head))::VARCHAR || '-' || a_end::VARCHAR, ' ' ORDER BY turn)
    FILTER (WHERE turn >= cut AND role = 'assistant'), '') AS chosen_trained,
  coalesce(string_agg(b, '' ORDER BY turn) FILTER (WHERE turn >= cut), '') AS rejected,
  coalesce(string_agg((b_end - length(b) + length(head))::VARCHAR || '-' || b_end::VARCHAR, ' ' ORDER BY turn)
    FILTER (WHERE turn >= cut AND role = 'assistant'), '') AS rejected_trained
FROM m GROUP BY pair_id
"""

ORACLES["op12_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), o AS (
  SELECT row_id, lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS lang_count FROM o GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3
), c AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM o JOIN kept USING (lang, term) GROUP BY lang, source, term
), g AS (
  SELECT g.lang, g.source, coalesce(n, 0) AS n, coalesce(v, 0) AS v, coalesce(lang_n, 0) AS lang_n
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY lang, source) USING (lang, source)
  LEFT JOIN (SELECT lang, count(*)::HUGEINT AS v, sum(lang_count)::HUGEINT AS lang_n FROM kept GROUP BY lang) USING (lang)
), p AS (
  SELECT g.lang, g.source, term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + g.v) AS p,
         1 + (1000000000::HUGEINT * (lang_count + 1)) // (g.lang_n + g.v) AS q
  FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q
), k AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r
)
SELECT lang, source, part, item, value, rank FROM k WHERE part = 'pair' OR rank <= 200
"""

"""The registered queries of this subpackage: op1 to op13, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlog.llm import (ann_forest, byte_bpe, exact_dedup, html_extract, lm_scoring, mixing, near_dedup, phrase_mining,
                         quality_rules, suffix_dedup, toxicity, url_filter, whitening)
from flowlog.llm.common import fold

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: (host, path, verdict)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text").withColumn("training", fold("doc_id", 7) != 2)
    scored = lm_scoring.score_texts(docs, "training")
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages", "page_id", "url")
    rules = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in URL_RULES])))
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("removed_spans").cast("long").alias("n_spans"),
                      F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("text_digest").alias("text_sha256"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.systematic_mix(_read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_dedup.near_groups(_read(spark, sf_dir, "documents", "doc_id", "text"), width=3, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    labels = _read(spark, sf_dir, "labels", "doc_id", "toxic").where(fold("doc_id", 5) != 0)
    scored = toxicity.score_texts(docs, toxicity.train(docs, labels), keep_text=False)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("toxicity").alias("score"),
                         toxicity.predicted(F.col("toxicity")).alias("predicted"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.nearest_neighbours(_read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode(_read(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(VOCABULARY),
                            public_tokenizers.PATTERN, decoded_col="decoded")
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract_main_text(_read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(_read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    each = rows.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error",
                       F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "c"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(_read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.judge(_read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lm_score, op2_url_filter, op3_suffix_dedup, op4_exact_dedup, op5_source_mix, op6_near_dedup,
                            op7_toxicity, op8_ann, op9_byte_bpe, op10_html_text, op11_whiten, op12_phrases, op13_quality_rules)}

ORACLE: dict[str, str] = {
    "op2_url_filter": r"""
WITH parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
judged AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parsed)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged""",
    "op4_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.body) AS text_sha256
FROM n JOIN g ON n.body = g.body""",
    "op5_source_mix": r"""
WITH sized AS (
  SELECT doc_id, source, text,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
placed AS (
  SELECT *, CASE WHEN size > 0 THEN floor(log2(CAST(size AS DOUBLE)) * 2) + 1 ELSE 0 END AS class,
         floor(CAST(('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) / 4294967296.0 * 256) AS slot
  FROM sized),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM placed GROUP BY source),
bounded AS (SELECT *, source_size * 3 AS bound FROM per),
filled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(bound) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM bounded WINDOW w AS (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT arg_min(level, bound / weight) AS level FROM filled WHERE level * weight <= bound),
targets AS (SELECT source, source_size, least(CAST(bound AS DOUBLE), chosen.level * weight) AS target,
       CAST(('0x' || substr(md5('mix-offset|' || coalesce(source, '')), 1, 8)) AS BIGINT) / 4294967296.0 AS start FROM bounded, chosen),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, slot, size, doc_id) AS pos FROM placed)
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0 THEN size * CAST(floor(pos * (target / source_size) + start) - floor((pos - 1) * (target / source_size) + start) AS BIGINT)
            ELSE 0 END AS taken
FROM numbered JOIN targets ON numbered.source IS NOT DISTINCT FROM targets.source""",
    "op12_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM worded GROUP BY lang),
f AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, m, CAST(count(*) AS HUGEINT) AS f
      FROM placed, (VALUES (1), (2), (3), (4), (5)) AS t(m) WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
split AS (SELECT lang, g, m, f AS a, string_split(g, ' ') AS w FROM f WHERE m > 1),
cuts AS (SELECT lang, g, m, a, w, unnest(range(1, m)) AS k FROM split),
parts AS (SELECT lang, g, m, a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:], ' ') AS q FROM cuts),
scored AS (SELECT parts.*, l.f AS l, r.f AS r, n, (1000 * a * n) // (l.f * r.f) AS score
           FROM parts JOIN f AS l ON l.lang = parts.lang AND l.g = p JOIN f AS r ON r.lang = parts.lang AND r.g = q
           JOIN totals ON totals.lang = parts.lang),
best AS (SELECT lang, g, a, n, min(score) AS score, arg_min({'l': l, 'r': r}, score * 10 + k) AS cut FROM scored GROUP BY lang, g, a, n),
inside AS (SELECT DISTINCT split.lang, array_to_string(w[i:i + s - 1], ' ') AS g, s, a
           FROM split, (VALUES (2), (3), (4)) AS t(s), (VALUES (1), (2), (3), (4)) AS u(i) WHERE s < m AND i + s - 1 <= m),
kept AS (SELECT best.* FROM best WHERE NOT EXISTS (SELECT 1 FROM inside WHERE inside.lang = best.lang AND inside.g = best.g AND inside.a >= best.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept)
SELECT lang, rank, g AS phrase, CAST(a AS BIGINT) AS a, CAST(cut.l AS BIGINT) AS l, CAST(cut.r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000""",
    "op13_quality_rules": r"""
WITH rows AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, 'null') AS lang, coalesce('=' || source, 'null') AS source, coalesce(text, '') AS t
              FROM documents),
split AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM rows),
win AS (SELECT rid, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) > 2)),
again AS (SELECT rid, count(DISTINCT i + d) AS n FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win), (VALUES (0), (1), (2)) AS s(d)
          WHERE c > 1 GROUP BY rid),
counted AS (
  SELECT split.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(regexp_extract_all(t, '[A-Z]{2,}')) AS BIGINT) AS n_capitals
  FROM split LEFT JOIN again ON again.rid = split.rid),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
ratios AS (
  SELECT rid, lang, source, base_failed, rule, CASE WHEN d > 0 THEN (1000 * x) // d ELSE 0 END AS v FROM (
    SELECT rid, lang, source, base_failed, 'word_length' AS rule, word_chars AS x, n_words AS d FROM based UNION ALL
    SELECT rid, lang, source, base_failed, 'symbols', n_symbols, n_words FROM based UNION ALL
    SELECT rid, lang, source, base_failed, 'dup_lines', n_dup_lines, n_lines FROM based UNION ALL
    SELECT rid, lang, source, base_failed, 'repeat_words', n_repeat_words, n_words FROM based UNION ALL
    SELECT rid, lang, source, base_failed, 'capitals', n_capitals, n_words FROM based)),
sketch AS (SELECT lang, source, rule, CASE WHEN v < 128 THEN v ELSE (length(bin(v)) - 7) * 64 + (v >> (length(bin(v)) - 7)) END AS bucket, count(*) AS n
           FROM ratios WHERE NOT base_failed GROUP BY ALL),
levels AS (SELECT 1 AS level, lang, source, rule, bucket, n FROM sketch UNION ALL
           SELECT 2, lang, NULL, rule, bucket, sum(n) FROM sketch GROUP BY lang, rule, bucket UNION ALL
           SELECT 3, NULL, NULL, rule, bucket, sum(n) FROM sketch GROUP BY rule, bucket),
summed AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rule ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY level, lang, source, rule) AS docs FROM levels),
quart AS (SELECT level, lang, source, rule, max(docs) AS docs, min(bucket) FILTER (WHERE 100 * upto >= 25 * docs) AS b1,
                 min(bucket) FILTER (WHERE 100 * upto >= 75 * docs) AS b3 FROM summed GROUP BY ALL),
valued AS (SELECT level, lang, source, rule, docs, (b1 - greatest(b1 // 64 - 1, 0) * 64) << greatest(b1 // 64 - 1, 0) AS q1,
                  (b3 - greatest(b3 // 64 - 1, 0) * 64) << greatest(b3 // 64 - 1, 0) AS q3 FROM quart),
picked AS (SELECT o.lang, o.source, o.rule, CASE WHEN o.docs >= 50 THEN o.q1 WHEN l.docs >= 50 THEN l.q1 ELSE a.q1 END AS q1,
                  CASE WHEN o.docs >= 50 THEN o.q3 WHEN l.docs >= 50 THEN l.q3 ELSE a.q3 END AS q3
           FROM valued AS o JOIN valued AS l ON l.level = 2 AND l.lang = o.lang AND l.rule = o.rule JOIN valued AS a ON a.level = 3 AND a.rule = o.rule
           WHERE o.level = 1),
slack(rule, s) AS (VALUES ('word_length', 500), ('symbols', 30), ('dup_lines', 150), ('repeat_words', 110), ('capitals', 30)),
fences AS (SELECT lang, source, rule, q3 + 3 * greatest(q3 - q1, s) AS high, CASE WHEN rule = 'word_length' THEN q1 - 3 * greatest(q3 - q1, s) END AS low
           FROM picked JOIN slack USING (rule)),
broken AS (SELECT DISTINCT rid FROM ratios JOIN fences USING (lang, source, rule) WHERE v > high OR v < low)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rid NOT IN (SELECT rid FROM broken) AS kept
FROM based""",
}

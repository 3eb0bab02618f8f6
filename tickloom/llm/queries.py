"""The registered queries of this package, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import quality_classifier, quality_rules, toxicity
from .exact_dedup import exact_dedup
from .hot import spread
from .jaccard_join import jaccard_components
from .labelled import held_out
from .mixing import mix_sources, sized
from .packing_sequences import pack_sequences
from .scratch import Scratch
from .substring_dedup import substring_dedup
from .token_counts import n_tokens
from .url_filter import Rule, filter_urls

TOKEN_LIMIT = 512
URL_RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and text of all documents."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir)
    counted = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), n_tokens(F.col("text"), public_tokenizers.path("byte_bpe_50k.json")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return exact_dedup(docs, Scratch(spark, "op2")).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
       CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) = 1 AS kept,
       text_sha256
FROM d
"""


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
verdicts AS (
  SELECT page_id, host, path, h || p AS rule, v
  FROM parts LEFT JOIN rules ON (host = h OR suffix(host, '.' || h)) AND prefix(path, p))
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, coalesce(arg_max(v, length(rule)), 'allow') AS verdict
FROM verdicts GROUP BY page_id, host, path
"""


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op4")
    sizes = scratch.save(sized(spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))), "sizes")
    return mix_sources(sizes, scratch).select("doc_id", "size", "source_size", "target", "taken")


#: sizes, sources and plan of the mix as common table expressions over a table {docs}.
MIX_CTES = r"""
sizes AS (
  SELECT doc_id, source, text, lang, n_chars,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM {docs}),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM sizes GROUP BY source),
levels AS (
  SELECT *,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY source_size * (6 // weight), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remains,
         sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY source_size * (6 // weight), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS others
  FROM ranked),
opened AS (SELECT *, remains * weight < 3 * source_size * others AS is_open FROM levels),
target AS (
  SELECT source, source_size, is_open,
         CASE WHEN is_open THEN CAST(max(CASE WHEN is_open THEN remains END) OVER () * weight AS DOUBLE) / CAST(max(CASE WHEN is_open THEN others END) OVER () AS DOUBLE)
              ELSE CAST(3 * source_size AS DOUBLE) END AS target
  FROM opened),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM target),
running AS (
  SELECT s.*, source_size, target, copies, is_open, target - copies * source_size AS budget,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS BIGINT) AS reached,
         CAST(sum(size) OVER (PARTITION BY s.source, h) AS BIGINT) AS m
  FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
bounds AS (
  SELECT source, arg_min(h, reached) + CASE WHEN 2 * (min(budget) - min(reached) + arg_min(m, reached)) > arg_min(m, reached) THEN 1 ELSE 0 END AS bound
  FROM running WHERE reached > budget AND is_open GROUP BY source),
mixed AS (
  SELECT r.*, copies + CASE WHEN h < coalesce(bound, 0) THEN 1 ELSE 0 END AS n_copies
  FROM running r LEFT JOIN bounds b ON r.source IS NOT DISTINCT FROM b.source)
"""
OP4_SQL = "WITH " + MIX_CTES.replace("{docs}", "documents") + "SELECT doc_id, size, source_size, target, size * n_copies AS taken FROM mixed"


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return substring_dedup(docs, with_text=False, scratch=Scratch(spark, "op5")).drop("kept_text")


OP5_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT rid, doc_id, i, array_to_string(words[i : i + 12], ' ') AS sequence
  FROM (SELECT rid, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM texts)),
firsts AS (SELECT sequence, min(doc_id) AS least FROM windows GROUP BY sequence),
marked AS (SELECT rid, i FROM windows JOIN firsts USING (sequence) WHERE least < coalesce(doc_id, 9223372036854775807)),
gone AS (SELECT DISTINCT rid, i + j AS i FROM marked, range(0, 13) AS t(j)),
every AS (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM texts),
kept AS (
  SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS rest
  FROM every ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (rid)
"""


def op6_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir)
    return pack_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), Scratch(spark, "op6"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), Scratch(spark, "op8"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return jaccard_components(docs, Scratch(spark, "op9")).select("doc_id", "n_shingles", "component_id")


OP9_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
sets AS (
  SELECT rid, doc_id,
         CASE WHEN len(words) = 0 THEN []
              WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
              ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' '))) END AS shingles
  FROM texts),
ids AS (SELECT rid, doc_id, len(shingles) AS n, CASE WHEN len(shingles) > 0 THEN sha256(array_to_string(list_sort(shingles), chr(10))) END AS sid, shingles FROM sets),
elements AS (SELECT sid, n, unnest(shingles) AS shingle FROM (SELECT sid, any_value(n) AS n, any_value(shingles) AS shingles FROM ids WHERE sid IS NOT NULL GROUP BY sid)),
links AS (
  SELECT a.sid AS a, b.sid AS b
  FROM elements a JOIN elements b ON a.shingle = b.shingle AND a.sid <> b.sid AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.sid, b.sid, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (SELECT DISTINCT a AS node, a AS other FROM links UNION SELECT r.node, l.b FROM reached r JOIN links l ON r.other = l.a),
groups AS (SELECT node, other FROM reached UNION SELECT sid, sid FROM ids WHERE sid IS NOT NULL),
least_ids AS (SELECT g.node, min(i.doc_id) AS component_id FROM groups g JOIN ids i ON i.sid = g.other GROUP BY g.node)
SELECT i.doc_id, CAST(i.n AS BIGINT) AS n_shingles, coalesce(l.component_id, i.doc_id) AS component_id
FROM ids i LEFT JOIN least_ids l ON l.node = i.sid
"""


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")), with_text=False)


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``op10_quality_rules`` says without its model, for which there is SQL."""
    return op10_quality_rules(spark, sf_dir).drop("llr", "kept")


BASE_COUNTS_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM texts),
repeats AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
windows AS (SELECT rid, i, array_to_string(words[i : i + 2], ' ') AS sequence FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM texts)),
often AS (SELECT rid, sequence FROM windows GROUP BY rid, sequence HAVING count(*) > 1),
covered AS (SELECT rid, count(DISTINCT i + j) AS n FROM windows JOIN often USING (rid, sequence), range(0, 3) AS t(j) GROUP BY rid),
counts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM texts LEFT JOIN repeats r USING (rid) LEFT JOIN covered c USING (rid))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_mix_sources": op4_mix_sources,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_pack_sequences": op6_pack_sequences,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_toxicity": op8_toxicity,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "quality_base_counts": quality_base_counts,
}
SQL: dict[str, str] = {"op2_exact_dedup": OP2_SQL, "op3_url_filter": OP3_SQL, "op4_mix_sources": OP4_SQL, "op5_substring_dedup": OP5_SQL, "op9_jaccard_join": OP9_SQL, "quality_base_counts": BASE_COUNTS_SQL}

"""Registered queries of this folder, and the SQL of those that SQL can express.

Each takes (spark, sf_dir) and applies its operator, with the parameters of
production, to the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.llm import audit, decontamination, hardneg, linededup, lm, neardup, packing, pii, quality, secretscan, suffixes, toxicity, urlfilter
from folia.llm.common import read, ship

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.secrets(read(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(read(spark, sf_dir, "documents"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_model(read(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(read(spark, sf_dir, "embeddings"), label=label)


# Host, path and verdict of the rules.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.url_filter(read(spark, sf_dir, "pages"), rules)


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_interactions(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def shipped(query: Query) -> Query:
    """The query with this library sent to the executors first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {f.__name__: shipped(f) for f in (op1_quality_rules, op2_secret_scans, op3_line_dedup, op4_minhash_near_dedup, op5_lm_scoring, op6_benchmark_decontamination, op7_pii, op8_packing, op9_suffix_array_dedup, op10_toxicity, op11_hard_negatives, op12_url_filters, op13_filter_interactions)}
ORACLE: dict[str, str] = {
    "op3_line_dedup": """
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, lower_ascii AS key FROM (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM lines)
), repeated AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id > r.first_doc AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256,
  length(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS n_kept_chars
FROM judged GROUP BY doc_id""",
    "op11_hard_negatives": """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS cells
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
    list_inner_product(a.cells, r.cells)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM valid WHERE vec_id % 100 = 0) a JOIN valid r ON a.vec_id <> r.vec_id
), positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INT AS rank
  FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5""",
    "op12_url_filters": r"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), judged AS (
  SELECT *, '.' || host AS dotted, CASE
    WHEN dotted LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN dotted LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN dotted LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN dotted LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged""",
    "op13_filter_interactions": r"""
WITH letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, s::INT AS step, substr(filter_order, s, 1) AS f, substr(filter_order, 1, s - 1) AS earlier
  FROM orders, range(1, 6) t(s)
), plain AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), judged AS (
  SELECT part, doc_id, (CASE WHEN len(words) < 100 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails
  FROM plain
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad
  FROM judged LEFT JOIN marks USING (doc_id) GROUP BY part, fails
), met AS (
  SELECT part, filter_order, step, f, n, good, bad, fails,
    contains(fails, f) AS hit, length(translate(fails, earlier, '')) < length(fails) AS gone
  FROM counts, steps
), told AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN hit AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN hit AND NOT gone THEN bad ELSE 0 END)::BIGINT AS toxic_lost
  FROM met GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM told""",
}

"""Queries that choose rows: resampling, hard negatives, language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import hard_negatives, importance_resampling, language_id
from flowlake.llm.queries_models import held_out
from flowlake.llm.tables import query, table

SEED, PERCENT, LEAST_WORDS = 2024, 10, 20

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
RESAMPLING_SQL = f"""
WITH doc_words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item_words AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
step AS (SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS v
    FROM (SELECT unnest(range(256)) AS b))),
uses AS (SELECT doc_id, unnest(w) AS w FROM doc_words),
words AS (SELECT w, xor(list_reduce(list_transform(regexp_extract_all(hex(w), '..'), lambda h: ('0x' || h)::BIGINT),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
    FROM (SELECT w FROM uses UNION SELECT w FROM item_words), step),
corpus AS (SELECT bucket, count(*) AS s FROM uses JOIN words USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM item_words JOIN words USING (w) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM uses) + 10000)
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM item_words) + 10000))))::BIGINT AS gain
    FROM (SELECT unnest(range(10000)) AS bucket) LEFT JOIN corpus USING (bucket) LEFT JOIN target USING (bucket)),
sums AS (SELECT doc_id, sum(gain)::BIGINT AS total FROM uses JOIN words USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
noise AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(floor(total / len(w)), 0)::BIGINT AS weight,
        ('0x' || sha256('{SEED}:' || doc_id)[1:8])::BIGINT AS h
    FROM doc_words LEFT JOIN sums USING (doc_id)),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296::DOUBLE)))::BIGINT AS score FROM noise),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, {PERCENT} * count(*) OVER () // 100 AS n
    FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN r <= n THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)"""


@query("op11_importance_resampling", RESAMPLING_SQL)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), SEED, PERCENT, LEAST_WORDS)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    noisy = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, noisy)


@query("op13_language_id")
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language_id.fit(docs, lambda doc_id: ~held_out(doc_id))
    named = language_id.identify(docs, profiles)
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

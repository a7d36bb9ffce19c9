"""Queries for decontamination and for repeats between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import decontaminate, jaccard_join, substring_dedup
from flowlake.llm.tables import query, table

_BENCHMARK_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION_SQL = f"""
WITH item_words AS (SELECT item_id, {_BENCHMARK_WORDS} AS w FROM benchmark),
patterns AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (SELECT doc_id, {_BENCHMARK_WORDS} AS w FROM documents),
places AS (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS p
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM doc_words, (SELECT DISTINCT k FROM patterns) WHERE len(w) >= k)),
found AS (SELECT doc_id, item_id, i, places.k FROM places JOIN patterns ON places.p = patterns.p AND places.k = patterns.k),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op1_decontamination", DECONTAMINATION_SQL)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(
        "doc_id", "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.find_components(table(spark, sf_dir, "documents"))


REPEATS_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS p
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
firsts AS (SELECT p, min(ROW(doc_id, i)) AS f FROM windows GROUP BY p HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM windows JOIN firsts USING (p) WHERE ROW(doc_id, i) > f),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM words) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""


@query("op10_substring_dedup", REPEATS_SQL)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

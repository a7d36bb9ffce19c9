"""Queries that scan texts: secrets, surrogates, lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import line_dedup, secret_scan, surrogates
from flowlake.llm.tables import query, table


def _sql_rules() -> str:
    """The rules as the contract states them: runs of any length, measured
    afterwards."""
    plain = {"access": (r"AKIA[A-Z0-9]+", 0, 20), "hex": (r"[0-9a-f]+", 0, 24)}
    rows = []
    for rank, rule in enumerate(secret_scan.RULES):
        pattern, group, least = plain.get(rule.kind, (rule.pattern, rule.group, rule.least))
        rows.append((rank, rule.kind, "'" + pattern.replace("'", "''") + "'", group, least))
    one = lambda rank, kind, pattern, group, least: (
        f"SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, regexp_extract_all(text, {pattern}, 0) AS m,"
        f" regexp_extract_all(text, {pattern}, {group}) AS v, regexp_split_to_array(text, {pattern}) AS g FROM texts")
    return " UNION ALL ".join(one(*r) for r in rows)


SECRETS_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({_sql_rules()}),
each AS (SELECT doc_id, rank, kind, least, m[i] AS m, v[i] AS v, g[i] AS gap, i
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found)),
placed AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS stop FROM each),
spans AS (SELECT doc_id, rank, kind, (stop - length(m))::BIGINT AS start, kind || ':' || (stop - length(m))::BIGINT || ':' || stop::BIGINT AS span
    FROM placed WHERE length(v) >= least),
summed AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
    string_agg(span, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(summed.spans, '') AS spans
FROM texts LEFT JOIN summed USING (doc_id)"""


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op4_secret_scan", SECRETS_SQL)
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        "doc_id", *(count(k) for k in secret_scan.BASE_KINDS),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


LINES_SQL = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
full_lines AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k,
    len(regexp_split_to_array(trim(regexp_replace(line, '\s+', ' ', 'g')), ' ')) AS n FROM lines WHERE regexp_replace(line, '\s', '', 'g') <> ''),
following AS (SELECT *, lead(line) OVER d AS line2, lead(line, 2) OVER d AS line3, lead(i) OVER d AS i2, lead(i, 2) OVER d AS i3, lead(n) OVER d AS n2
    FROM full_lines WINDOW d AS (PARTITION BY doc_id ORDER BY k)),
windows AS (
    SELECT doc_id, k, [line, line2, line3] AS w, [i, i2, i3] AS covered FROM following WHERE i3 IS NOT NULL
    UNION ALL SELECT doc_id, k, [line, line2], [i, i2] FROM following WHERE n + n2 > 50
    UNION ALL SELECT doc_id, k, [line], [i] FROM following WHERE n > 50),
firsts AS (SELECT w, min(ROW(doc_id, k)) AS f FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(covered) AS i FROM windows JOIN firsts USING (w) WHERE ROW(doc_id, k) > f)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(g.i)::BIGINT AS n_removed,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id"""


@query("op5_line_dedup", LINES_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split("text", "\n", -1)).alias("before"))
    kept = line_dedup.delete_repeated_lines(docs)
    lines = F.when(F.col("text") == "", F.lit(0)).otherwise(F.size(F.split("text", "\n", -1)))
    return kept.select(
        "doc_id", F.col("before").cast("long").alias("n_lines"),
        (F.col("before") - lines).cast("long").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


# A fixed key for the tests; a real run takes its key from its own secret store.
TEST_KEY = b"surrogates for the test tables"


@query("op2_surrogates")
def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = surrogates.replace_entities(table(spark, sf_dir, "documents"), TEST_KEY)
    return new.select("doc_id", F.size("entities").cast("long").alias("n_entities"), F.col("new_text").alias("text"))

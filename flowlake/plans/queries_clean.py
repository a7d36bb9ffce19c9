"""Queries for cleaning, labels, dedup and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions import is_nonfinite, map_lookup
from flowlake.operators import clean, quality
from flowlake.plans import bindings as b
from flowlake.plans.catalog import once_per_application, query
from flowlake.plans.twins import (
    CONNECTION_CATEGORY,
    CONNECTION_KEY,
    FLOW_CATEGORY,
    FLOW_KEY,
    imputed,
    names,
    nonfinite,
    twin,
)
from flowlake.session import scratch_path
from flowlake.sources import readers
from flowlake.specs import CICIDS2017, NSL_KDD

RATES = CICIDS2017.rate_columns


@query("label_binary", twin("SELECT event_id, case when label = 'BENIGN' then 0 else 1 end AS is_attack FROM flow"))
def label_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.flows(spark, sf_dir).select(
        "event_id", clean.label_binary(F.col("label"), CICIDS2017.benign_label).alias("is_attack")
    )


@query("label_category", twin(
    f"SELECT {names(b.CONNECTION_ID)}, attack_type, {CONNECTION_CATEGORY} AS attack_category FROM conn"))
def label_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.connections(spark, sf_dir).select(
        *b.CONNECTION_ID, "attack_type",
        clean.label_category(F.col("attack_type"), NSL_KDD.taxonomy).alias("attack_category"),
    )


@query("impute_nonfinite", twin(
    "SELECT event_id, " + ", ".join(f'{imputed(c)} AS "{c}"' for c in RATES) + " FROM flow"))
def impute_nonfinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.impute_nonfinite(b.flows(spark, sf_dir), RATES).select("event_id", *RATES)


@query("filter_negative_duration", twin("SELECT event_id, flow_duration FROM flow WHERE flow_duration >= 0"))
def filter_negative_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_negative(b.flows(spark, sf_dir), "flow_duration").select("event_id", "flow_duration")


@query("filter_split", twin("SELECT event_id, label FROM flow WHERE split = 'test'"))
def filter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.filter_split(b.flows(spark, sf_dir), "test").select("event_id", "label")


@query("filter_label", twin("SELECT event_id, is_attack FROM pred WHERE is_attack = 1"))
def filter_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = clean.add_labels(b.flows(spark, sf_dir), CICIDS2017)
    return clean.filter_label(labelled, "is_attack", 1).select("event_id", "is_attack")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as two periods: customers are the labels."""
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.expr("case when o_orderdate < timestamp '1997-01-01 00:00:00' then 'train' else 'test' end").alias("split"),
    )


NEW_CUSTOMERS = """SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= timestamp '1997-01-01 00:00:00'
    AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < timestamp '1997-01-01 00:00:00')"""


@query("filter_in_list", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN ({NEW_CUSTOMERS})")
def filter_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    wanted = quality.novel_labels(orders, "o_custkey")
    return quality.rows_in_list(orders, "o_custkey", wanted).select("o_orderkey", "o_custkey")


@query("filter_in_long_list", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0)""")
def filter_in_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list that outgrows a literal with the tables: filtered by its bitmaps first."""
    listed = b.table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 5 != 0).select("o_orderkey")
    return quality.rows_in_list(b.table(spark, sf_dir, "lineitem").select(*b.CONNECTION_ID), "l_orderkey", listed)


@query("novel_labels", NEW_CUSTOMERS)
def novel_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.novel_labels(_orders(spark, sf_dir), "o_custkey")


@query("novel_rows", twin(f"""
    SELECT {names(b.CONNECTION_ID)}, attack_type FROM conn WHERE split = 'test'
    AND attack_type NOT IN (SELECT attack_type FROM conn WHERE split = 'train')"""))
def novel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.novel_rows(b.connections(spark, sf_dir), "attack_type").select(
        *b.CONNECTION_ID, "attack_type"
    )


@query("unmapped_labels", twin(
    "SELECT DISTINCT label FROM flow WHERE label NOT IN ('BENIGN', 'DDoS', 'PortScan')"))
def unmapped_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unmapped_labels(b.flows(spark, sf_dir), "label", CICIDS2017.taxonomy)


@query("row_counts_by_source", twin('SELECT source_day, count(*) AS "rows" FROM flow GROUP BY source_day'))
def row_counts_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts(b.flows(spark, sf_dir), "source_day")


@query("distinct_labels", twin("SELECT DISTINCT attack_type FROM conn"))
def distinct_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_labels(b.connections(spark, sf_dir), "attack_type")


@query("count_distinct_labels", twin(
    "SELECT split, count(DISTINCT attack_type) AS distinct_labels FROM conn GROUP BY split"))
def count_distinct_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.count_distinct_labels(b.connections(spark, sf_dir), "attack_type")


def _sum(condition: str, value: str = "1") -> str:
    return f"cast(coalesce(sum(case when {condition} then {value} else 0 end), 0) as bigint)"


def _metric(metric: str, key: str, value: str, source: str) -> str:
    return f"""SELECT '{metric}' AS metric, '{key}' AS "key", cast({value} as bigint) AS value FROM {source}"""


DQ_CONNECTIONS = " UNION ALL ".join([
    _metric("raw_row_counts", "train", _sum("split = 'train'"), "raw_conn"),
    _metric("raw_row_counts", "test", _sum("split = 'test'"), "raw_conn"),
    _metric("total_raw_rows", "", "count(*)", "raw_conn"),
    _metric("duplicates_removed", "", "(SELECT count(*) FROM raw_conn) - count(*)", "clean_conn"),
    _metric("final_cleaned_rows", "", "count(*)", "clean_conn"),
    _metric("distinct_attack_types", "train", "count(DISTINCT case when split = 'train' then attack_type end)", "raw_conn"),
    _metric("distinct_attack_types", "test", "count(DISTINCT case when split = 'test' then attack_type end)", "raw_conn"),
    """SELECT 'novel_attack_types_in_test_not_in_train', attack_type, count(*) FROM raw_conn
       WHERE split = 'test' AND attack_type NOT IN (SELECT attack_type FROM raw_conn WHERE split = 'train')
       GROUP BY attack_type""",
    """SELECT 'attack_types_with_no_category_mapping', attack_type, count(*) FROM raw_conn
       WHERE attack_type NOT IN ('normal', 'neptune', 'satan', 'guess_passwd', 'rootkit') GROUP BY attack_type""",
])


@once_per_application
def _folded(spark: SparkSession, sf_dir: str, dataset: str) -> str:
    """Where the fold of a dataset's raw rows has been stored."""
    raw, spec = {
        NSL_KDD.name: (b.raw_connections, NSL_KDD), CICIDS2017.name: (b.raw_flows, CICIDS2017),
    }[dataset]
    path = scratch_path(spark, f"folded-{dataset}")
    quality.fold(raw(spark, sf_dir), spec).write.parquet(path)
    return path


@query("clean_conn_folded", twin("SELECT * FROM clean_conn"))
def clean_conn_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table from the stored fold, which also gives the report."""
    return clean.clean_folded(spark.read.parquet(_folded(spark, sf_dir, NSL_KDD.name)), NSL_KDD)


@query("dq_stats_conn_folded", twin(DQ_CONNECTIONS))
def dq_stats_conn_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_stats_folded(spark.read.parquet(_folded(spark, sf_dir, NSL_KDD.name)), NSL_KDD)


@query("dq_stats_conn", twin(DQ_CONNECTIONS))
def dq_stats_conn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_stats_connections(b.raw_connections(spark, sf_dir), NSL_KDD)


DQ_FLOWS = " UNION ALL ".join([
    *[_metric("raw_row_counts_by_day", d, _sum(f"source_day = '{d}'"), "flow") for d in b.DAYS],
    _metric("total_raw_rows", "", "count(*)", "flow"),
    _metric("negative_duration_rows_dropped", "", _sum("flow_duration < 0"), "flow"),
    _metric("null_duration_rows_dropped", "", _sum("flow_duration is null"), "flow"),
    *[_metric("rate_column_infinity_or_nan_imputed", c, _sum(f"flow_duration >= 0 and {nonfinite(c)}"), "flow")
      for c in RATES],
    *[_metric("rate_column_null", c, _sum(f'flow_duration >= 0 and "{c}" is null'), "flow") for c in RATES],
    _metric("duplicates_removed", "", "(SELECT count(*) FROM valid_flow) - count(*)", "dedup_flow"),
    _metric("final_cleaned_rows", "", "count(*)", "dedup_flow"),
    """SELECT 'labels_with_no_category_mapping', label, count(*) FROM flow
       WHERE label NOT IN ('BENIGN', 'DDoS', 'PortScan') GROUP BY label""",
])


@query("clean_flow_folded", twin(f"""
    SELECT *, case when label = 'BENIGN' then 0 else 1 end AS is_attack, {FLOW_CATEGORY} AS attack_category
    FROM dedup_flow"""))
def clean_flow_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_folded(spark.read.parquet(_folded(spark, sf_dir, CICIDS2017.name)), CICIDS2017)


@query("dq_stats_flow_folded", twin(DQ_FLOWS))
def dq_stats_flow_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_stats_folded(spark.read.parquet(_folded(spark, sf_dir, CICIDS2017.name)), CICIDS2017, b.DAYS)


@query("dq_stats_flow", twin(DQ_FLOWS))
def dq_stats_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_stats_flows(b.raw_flows(spark, sf_dir), CICIDS2017, b.DAYS)


NONFINITE_SUMS = ", ".join(f'{_sum(nonfinite(c))} AS "{c}"' for c in RATES)
NONFINITE_ALL = " + ".join(_sum(nonfinite(c)) for c in RATES)


@query("nonfinite_counts", twin(
    f"SELECT {NONFINITE_SUMS}, cast({NONFINITE_ALL} as bigint) AS nonfinite_total FROM flow"))
def nonfinite_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.nonfinite_counts(b.flows(spark, sf_dir), RATES)


@query("nonfinite_total", twin(f"SELECT cast({NONFINITE_ALL} as bigint) AS nonfinite_total FROM flow"))
def nonfinite_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.nonfinite_total(b.flows(spark, sf_dir), RATES)


@query("dedup_within_split", twin(
    f"SELECT {names(CONNECTION_KEY)}, min(difficulty) AS difficulty FROM raw_conn GROUP BY {names(CONNECTION_KEY)}"))
def dedup_within_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.dedup_within_split(b.raw_connections(spark, sf_dir), NSL_KDD)


@query("dedup_across_sources", twin(f"SELECT {names(FLOW_KEY)}, source_day, split FROM dedup_flow"))
def dedup_across_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = clean.drop_negative(b.raw_flows(spark, sf_dir), "flow_duration")
    return clean.dedup_across_sources(clean.impute_nonfinite(valid, RATES), CICIDS2017)


@query("dedup_first", """
    SELECT doc_id, source, lang, n_chars, text FROM (
        SELECT *, row_number() OVER (PARTITION BY text ORDER BY source, doc_id) AS rn FROM documents)
    WHERE rn = 1""")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-text copies across sources; the smallest (source, doc_id) stays."""
    return clean.dedup_first(
        b.table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text"),
        keys=["text"], order=["source", "doc_id"],
    )


@query("duplicates_removed", """
    SELECT cast(sum(n) as bigint) AS "rows", count(*) AS distinct_rows,
        cast(sum(n) - count(*) as bigint) AS duplicates_removed
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def duplicates_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.duplicates_removed(b.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("clean_conn", twin("SELECT * FROM clean_conn"))
def clean_conn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_connections(b.raw_connections(spark, sf_dir), NSL_KDD)


@query("clean_flow", twin(f"""
    SELECT *, case when label = 'BENIGN' then 0 else 1 end AS is_attack, {FLOW_CATEGORY} AS attack_category
    FROM dedup_flow"""))
def clean_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_flows(b.raw_flows(spark, sf_dir), CICIDS2017)


@query("union_splits", twin(f"SELECT {names(CONNECTION_KEY)} FROM conn"))
def union_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.connections(spark, sf_dir).select(*CONNECTION_KEY)
    return readers.union_all([clean.filter_split(rows, "train"), clean.filter_split(rows, "test")])


@query("union_days", twin("SELECT event_id, source_day, split FROM flow"))
def union_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.flows(spark, sf_dir).select("event_id", "source_day", "split")
    return readers.union_all([rows.filter(F.col("source_day") == d) for d in b.DAYS])


@query("fn_nonfinite", twin(f"SELECT event_id, {nonfinite('flow_bytes_per_s')} AS bad FROM flow"))
def fn_nonfinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.flows(spark, sf_dir).select("event_id", is_nonfinite(F.col("flow_bytes_per_s")).alias("bad"))


@query("fn_map_lookup", """
    SELECT doc_id, case lang when 'en' then 'English' when 'de' then 'German' else 'unknown' end AS language
    FROM documents""")
def fn_map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "documents").select(
        "doc_id", map_lookup(F.col("lang"), {"en": "English", "de": "German"}, "unknown").alias("language")
    )

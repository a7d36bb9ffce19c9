"""Queries on the common scored table."""

from __future__ import annotations

import hashlib

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions import json_payload, positive_probability, round_probability
from flowlake.operators import clean, serve
from flowlake.operators.rules import engineer_features
from flowlake.plans import bindings as b
from flowlake.plans.catalog import once_per_application, query
from flowlake.plans.queries_evaluate import connection_predictions, predictions
from flowlake.plans.twins import CONNECTION_ID, hashed, names, payload, twin
from flowlake.session import scratch_path
from flowlake.sources import readers, sinks
from flowlake.specs import CICIDS2017, NSL_KDD

SCORED_AT = "2024-06-01 00:00:00"
COMMON = names(serve.COMMON_COLUMNS)


def served_connections(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    rows = engineer_features(connection_predictions(spark, sf_dir, spread), NSL_KDD.rules)
    return serve.project_common_schema(
        rows, "nsl_kdd", NSL_KDD.features, key=b.CONNECTION_ID
    )


def served_flows(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    rows = engineer_features(predictions(spark, sf_dir, spread), CICIDS2017.rules)
    # JSON has no infinity, and leaves nulls out.
    rows = clean.impute_nonfinite(rows, CICIDS2017.rate_columns, null_as_nonfinite=True)
    return serve.project_common_schema(rows, "cicids2017", CICIDS2017.features, key=["event_id"])


def served(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return serve.union_datasets(served_connections(spark, sf_dir, spread), served_flows(spark, sf_dir, spread))


@once_per_application
def _served_table(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "flows-scored")
    sinks.write_partitioned(
        serve.stamp(served(spark, sf_dir, spread=True), SCORED_AT), path,
        by=("dataset_source", "split"), lookup_column="flow_id",
    )
    return path


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The served table as queries meet it: stored, by dataset and split."""
    return readers.read_table(spark, _served_table(spark, sf_dir)).select(*serve.COMMON_COLUMNS, "scored_at")


@query("project_common_schema", twin(f"SELECT {COMMON} FROM served WHERE dataset_source = 'nsl_kdd'"))
def project_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return served_connections(spark, sf_dir)


@query("project_common_schema_flow", twin(f"SELECT {COMMON} FROM served WHERE dataset_source = 'cicids2017'"))
def project_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return served_flows(spark, sf_dir)


@query("union_datasets", twin(f"SELECT {COMMON} FROM served"))
def union_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return served(spark, sf_dir)


@query("flow_id", twin(f"SELECT {names(CONNECTION_ID)}, {hashed('nsl_kdd', CONNECTION_ID)} AS flow_id FROM conn"))
def flow_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.connections(spark, sf_dir).select(
        *CONNECTION_ID, serve.flow_id("nsl_kdd", CONNECTION_ID).alias("flow_id")
    )


@query("flow_id_copies", twin(f"""
    SELECT protocol_type, service, flag,
        {hashed('nsl_kdd', ['protocol_type', 'service', 'flag'])} ||
        case row_number() OVER (PARTITION BY protocol_type, service, flag) when 1 then ''
             else '.' || cast(row_number() OVER (PARTITION BY protocol_type, service, flag) - 1 as varchar) end AS flow_id
    FROM conn"""))
def flow_id_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows that repeat many times still get ids of their own."""
    key = ["protocol_type", "service", "flag"]
    rows = b.connections(spark, sf_dir).select(*key, serve.flow_id("nsl_kdd", key).alias("flow_id"))
    return serve.number_copies(rows, "flow_id", chunk=100)


@query("raw_features_json", twin(f"SELECT {names(CONNECTION_ID)}, {payload(NSL_KDD.features)} AS raw_features FROM conn"))
def raw_features_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.connections(spark, sf_dir).select(*CONNECTION_ID, json_payload(NSL_KDD.features).alias("raw_features"))


@query("fn_to_json", """
    SELECT c_custkey, cast(to_json({'c_name': c_name, 'c_acctbal': c_acctbal, 'c_nationkey': c_nationkey}) as varchar)
        AS payload FROM customer""")
def fn_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "customer").select(
        "c_custkey", json_payload(["c_name", "c_acctbal", "c_nationkey"]).alias("payload")
    )


@query("round_probability", twin("""
    SELECT event_id, round(attack_probability / cast(3 as double), 5) AS attack_probability FROM flow"""))
def round_probability_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.flows(spark, sf_dir).select(
        "event_id", round_probability(F.col("attack_probability") / 3.0).alias("attack_probability")
    )


@query("probability_from_vector", twin("SELECT event_id, attack_probability FROM flow"))
def probability_from_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = b.flows(spark, sf_dir).select(
        "event_id",
        array_to_vector(F.array(1 - F.col("attack_probability"), F.col("attack_probability"))).alias("probability"),
    )
    return vectors.select(
        "event_id", positive_probability(F.col("probability")).alias("attack_probability")
    )


@query("prediction_cast", twin("SELECT flow_id, predicted_label FROM served"))
def prediction_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return served(spark, sf_dir).select("flow_id", "predicted_label")


@query("label_display", twin("""
    SELECT flow_id, case predicted_label when 1 then 'Attack' else 'Benign' end AS label_display FROM served"""))
def label_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.add_label_display(served(spark, sf_dir)).select("flow_id", "label_display")


@query("filter_optional_conjunction", twin("""
    SELECT flow_id, attack_category_actual FROM served
    WHERE dataset_source = 'cicids2017' AND split = 'test' AND predicted_label = 0 AND attack_category_actual = 'DoS'"""))
def filter_optional_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.filter_flows(
        stored(spark, sf_dir), dataset="cicids2017", split="test", predicted_label=0, attack_category="DoS"
    ).select("flow_id", "attack_category_actual")


@query("filter_dataset", twin("SELECT flow_id, duration FROM served WHERE dataset_source = 'nsl_kdd'"))
def filter_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.filter_flows(stored(spark, sf_dir), dataset="nsl_kdd", split="").select("flow_id", "duration")


# The id of the event with event_id 77, as any client would hold it.
WANTED_ID = "cicids2017-" + hashlib.sha256(b"2:77").hexdigest()[:32]


@query("lookup_by_id", twin(f"SELECT {COMMON} FROM served WHERE flow_id = '{WANTED_ID}'"))
def lookup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.lookup_by_id(stored(spark, sf_dir), WANTED_ID).drop("scored_at")


@query("flows_page", twin(f"""
    SELECT {COMMON}, (SELECT count(*) FROM served WHERE split = 'test') AS total FROM served
    WHERE split = 'test' ORDER BY flow_id LIMIT 50 OFFSET 100"""))
def flows_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = serve.flows_page(stored(spark, sf_dir), limit=50, offset=100, split="test")
    return page.items.withColumn("total", page.total.scalar()).drop("scored_at")


@query("flows_page_deep", twin(f"SELECT {COMMON} FROM served ORDER BY flow_id LIMIT 200 OFFSET 5000"))
def flows_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path deep offsets take, at an offset the test data has."""
    flows = stored(spark, sf_dir)
    return serve.fetch_page(flows, serve.deep_page_keys(flows, limit=200, offset=5000)).drop("scored_at")


STATS = """count(*) AS total_flows, cast(sum(is_attack_actual) as bigint) AS actual_attack_count,
    cast(sum(predicted_label) as bigint) AS predicted_attack_count,
    round(avg(attack_probability), 6) AS avg_attack_probability"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_attack_probability", F.round("avg_attack_probability", 6))


@query("dataset_stats", twin(f"SELECT dataset_source, split, {STATS} FROM served GROUP BY dataset_source, split"))
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(serve.dataset_stats(stored(spark, sf_dir)))


@query("ordered_outputs", twin(
    f"SELECT dataset_source, split, {STATS} FROM served GROUP BY dataset_source, split ORDER BY dataset_source, split"))
def ordered_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(serve.dataset_stats(stored(spark, sf_dir)))


@query("summary_stats", twin(
    f"SELECT dataset_source, {STATS} FROM served WHERE dataset_source = 'nsl_kdd' GROUP BY dataset_source"))
def summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(serve.summary_stats(stored(spark, sf_dir), "nsl_kdd"))


@query("predicted_attack_rate", twin("""
    SELECT dataset_source, round(cast(sum(predicted_label) as double) / count(*), 6) AS predicted_attack_rate
    FROM served WHERE dataset_source = 'nsl_kdd' GROUP BY dataset_source"""))
def predicted_attack_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = serve.predicted_attack_rate(serve.summary_stats(stored(spark, sf_dir), "nsl_kdd"))
    return rate.select("dataset_source", F.round("predicted_attack_rate", 6).alias("predicted_attack_rate"))


@query("category_breakdown", twin("""
    SELECT attack_category_actual AS attack_category, count(*) AS total_flows,
        cast(sum(predicted_label) as bigint) AS predicted_attack_count
    FROM served GROUP BY attack_category_actual"""))
def category_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.category_breakdown(stored(spark, sf_dir))

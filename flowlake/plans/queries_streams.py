"""Queries that follow a growing folder, compared with what a table gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.operators import learn
from flowlake.plans import bindings as b
from flowlake.plans import workflow
from flowlake.plans.catalog import query
from flowlake.plans.queries_learn import _features, _model, _partial
from flowlake.plans.twins import CONNECTION_FLAGS_SQL, FLOW_CATEGORY, FLOW_FLAGS_SQL, flag_names, names, twin
from flowlake.session import scratch_path
from flowlake.specs import CICIDS2017, NSL_KDD
from flowlake.streaming import features, scoring


def _arriving(spark: SparkSession, rows: DataFrame, half: str, run) -> None:
    """Writes the rows to a folder in two lots and calls run(stream) after each."""
    source = scratch_path(spark, "arriving")
    for part in (half, f"NOT ({half})"):
        rows.filter(part).write.mode("append").parquet(source)
        run(features.follow_table(spark, source, rows.schema)).awaitTermination()


@query("stream_features", twin(f"""
    SELECT event_id, {names(CICIDS2017.rate_columns)}, case when label = 'BENIGN' then 0 else 1 end AS is_attack,
        {FLOW_CATEGORY} AS attack_category, {flag_names(FLOW_FLAGS_SQL)} AS rule_flags FROM valid_flow"""))
def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, imputation and labels of rows that arrive in two lots."""
    out, checkpoint = scratch_path(spark, "streamed-features"), scratch_path(spark, "stream-checkpoint")
    _arriving(spark, b.flows(spark, sf_dir), "event_id % 3 = 0",
              lambda rows: features.append_features(rows, CICIDS2017, out, checkpoint))
    return spark.read.parquet(out).select("event_id", *CICIDS2017.rate_columns, "is_attack", "attack_category", "rule_flags")


@query("stream_score", twin(f"""
    SELECT 'nsl_kdd' AS dataset_source, split, protocol_type AS protocol, duration, src_bytes AS bytes_sent,
        dst_bytes AS bytes_received, is_attack AS is_attack_actual, {flag_names(CONNECTION_FLAGS_SQL)} AS rule_flags,
        true AS same FROM clean_conn"""))
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature row scored as it arrives, against the whole table scored."""
    out, checkpoint = scratch_path(spark, "streamed-scores"), scratch_path(spark, "stream-checkpoint")
    model, table = _model(spark, sf_dir), _features(spark, sf_dir, NSL_KDD.name)
    key = workflow.unique_key(NSL_KDD)
    _arriving(spark, table, "difficulty > 3", lambda rows: scoring.score_features(model, rows, NSL_KDD, out, checkpoint, key))
    whole = learn.score_dataset(model, table, NSL_KDD, key)
    again = whole.select("flow_id", F.col("attack_probability").alias("p"), F.col("predicted_label").alias("l"))
    same = (F.col("attack_probability") == F.col("p")) & (F.col("predicted_label") == F.col("l"))
    return spark.read.parquet(out).join(again, "flow_id", "full").select(
        "dataset_source", "split", "protocol", "duration", "bytes_sent", "bytes_received", "is_attack_actual", "rule_flags",
        F.coalesce(same, F.lit(False)).alias("same"))


@query("stream_score_partial", f"SELECT {names(b.CONNECTION_ID)}, true AS same FROM lineitem")
def stream_score_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial records scored as they arrive, against all of them at once."""
    out, checkpoint = scratch_path(spark, "streamed-records"), scratch_path(spark, "stream-checkpoint")
    model, records = _model(spark, sf_dir), _partial(spark, sf_dir)
    _arriving(spark, records, "l_linenumber % 2 = 1",
              lambda rows: scoring.score_records(model, rows, NSL_KDD, out, checkpoint, b.CONNECTION_ID))
    whole = learn.score_partial(model, records, NSL_KDD, keep=b.CONNECTION_ID)
    answers = ("attack_probability", "predicted_label", "rule_flags", "features_used", "invalid_features")
    # Ids may repeat: whole answers are counted on both sides.
    sides = [
        rows.select(*b.CONNECTION_ID, F.struct(*answers).alias("answer"), F.lit(n).alias("n"))
        for n, rows in ((1, spark.read.parquet(out)), (-1, whole))
    ]
    counts = sides[0].unionAll(sides[1]).groupBy(*b.CONNECTION_ID, "answer").agg(
        F.sum("n").alias("difference"), F.count_if(F.col("n") > 0).alias("streamed"), F.count_if(F.col("n") < 0).alias("batch"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.greatest("streamed", "batch")))
    return counts.withColumn("copy", copies).select(*b.CONNECTION_ID, (F.col("difference") == 0).alias("same"))

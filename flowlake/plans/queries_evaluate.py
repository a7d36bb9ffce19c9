"""Queries for evaluation. The "model" is a fixed function of the row, so every
figure has a SQL twin; the operators are the ones the trainer calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions import safe_ratio, snap
from flowlake.operators import clean, evaluate, learn, quality
from flowlake.plans import bindings as b
from flowlake.plans.catalog import query
from flowlake.plans.twins import twin
from flowlake.specs import CICIDS2017, NSL_KDD

RESOLUTION = 0.05


def predictions(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return clean.add_labels(b.flows(spark, sf_dir, spread), CICIDS2017)


def connection_predictions(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    labelled = clean.add_labels(b.connections(spark, sf_dir, spread), NSL_KDD)
    return labelled.withColumns({
        "attack_probability": F.col("duration") / 100,
        "prediction": F.expr("case when src_bytes > 60000 then 1D else 0D end"),
    })


def _cell(actual: int, predicted: int) -> str:
    return f"cast(sum(case when is_attack = {actual} and prediction = {predicted} then 1 else 0 end) as bigint)"


CELLS = f"""{_cell(0, 0)} AS true_negative, {_cell(0, 1)} AS false_positive,
    {_cell(1, 0)} AS false_negative, {_cell(1, 1)} AS true_positive"""


@query("confusion_matrix", twin(f"SELECT {CELLS} FROM pred"))
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(predictions(spark, sf_dir))


PRF = twin(f"""
    SELECT true_negative, false_positive, false_negative, true_positive,
        round(p, 5) AS "precision", round(r, 5) AS recall, round(2 * p * r / (p + r), 5) AS f1
    FROM (SELECT *, cast(true_positive as double) / (true_positive + false_positive) AS p,
                 cast(true_positive as double) / (true_positive + false_negative) AS r
          FROM (SELECT {CELLS} FROM pred))""")


@query("precision_recall_f1", PRF)
def precision_recall_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the cube, as the trainer does it."""
    return evaluate.precision_recall_f1(evaluate.evaluation_cube(predictions(spark, sf_dir)))


@query("category_detection", twin("""
    SELECT attack_category, count(*) AS "count",
        cast(sum(case when prediction = 1 then 1 else 0 end) as bigint) AS predicted_attack_count,
        round(cast(sum(case when prediction = 1 then 1 else 0 end) as double) / count(*), 5) AS detection_rate
    FROM pred GROUP BY attack_category"""))
def category_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.category_detection(predictions(spark, sf_dir))


@query("evaluation_cube", twin("""
    SELECT is_attack, prediction, attack_category,
        round(round(attack_probability / cast(0.05 as double)) * cast(0.05 as double), 5) AS score_bucket,
        count(*) AS "rows"
    FROM pred GROUP BY 1, 2, 3, 4"""))
def evaluation_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = evaluate.evaluation_cube(predictions(spark, sf_dir), RESOLUTION)
    return cube.withColumn("score_bucket", F.round("score_bucket", 5))


@query("threshold_curve", twin('SELECT threshold, "precision", recall, f1 FROM curve'))
def threshold_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.threshold_curve(predictions(spark, sf_dir), RESOLUTION)


@query("best_threshold", twin('SELECT threshold, "precision", recall, f1 FROM curve ORDER BY f1 DESC, threshold DESC LIMIT 1'))
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.best_threshold(evaluate.threshold_curve(predictions(spark, sf_dir), RESOLUTION))


SNAPPED = "round(round(attack_probability / cast(0.05 as double)) * cast(0.05 as double), 5)"


@query("score_bucket", twin(f"SELECT event_id, {SNAPPED} AS score_bucket FROM flow"))
def score_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucketed = evaluate.score_bucket(predictions(spark, sf_dir), RESOLUTION)
    return bucketed.select("event_id", F.round("score_bucket", 5).alias("score_bucket"))


@query("fn_bucket_round", """
    SELECT o_orderkey, round(round(o_totalprice / cast(250 as double)) * cast(250 as double), 2) AS price_band
    FROM orders""")
def fn_bucket_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.round(snap(F.col("o_totalprice"), 250.0), 2).alias("price_band")
    )


@query("attack_rates", twin("""
    SELECT count(*) FILTER (split = 'test') AS test_rows, count(*) FILTER (split = 'train') AS train_rows,
        round(avg(is_attack) FILTER (split = 'test'), 5) AS attack_rate_test,
        round(avg(is_attack) FILTER (split = 'train'), 5) AS attack_rate_train
    FROM pred"""))
def attack_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.attack_rates(predictions(spark, sf_dir))


@query("novel_detection_rate", twin("""
    SELECT count(*) AS novel_total, cast(sum(case when prediction = 1 then 1 else 0 end) as bigint) AS novel_caught,
        round(cast(sum(case when prediction = 1 then 1 else 0 end) as double) / count(*), 5)
            AS novel_attack_detection_rate
    FROM conn_pred WHERE split = 'test'
        AND attack_type NOT IN (SELECT attack_type FROM conn_pred WHERE split = 'train')"""))
def novel_detection_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = connection_predictions(spark, sf_dir)
    novel = quality.bounded(quality.novel_labels(rows, "attack_type"))
    marked = learn.mark_novel(clean.filter_split(rows, "test"), novel, "attack_type")
    return evaluate.novel_detection_rate(marked)


@query("ml_auc_roc", twin("""
    SELECT round(sum(n * (2 * cp - p) / cast(2 as double)) / (cast(sum(p) as double) * sum(n)), 5) AS auc_roc
    FROM ranked"""))
def ml_auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.auc_roc(_scored(spark, sf_dir))


@query("ml_auc_pr", twin("""
    SELECT round(sum(p * (h + coalesce(e, h)) / 2) / sum(p), 5) AS auc_pr
    FROM (SELECT p, cast(cp as double) / (cp + cn) AS h,
          case when cp + cn - p - n = 0 then null else cast(cp - p as double) / (cp + cn - p - n) end AS e FROM ranked)"""))
def ml_auc_pr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.auc_pr(_scored(spark, sf_dir))


@query("ml_auc_nulls", twin("""
    SELECT round(sum(n * (2 * cp - p) / cast(2 as double)) / (cast(sum(p) as double) * sum(n)), 5) AS auc_roc,
        (SELECT count(*) FROM pred WHERE event_id % 10 <= 1) AS unscored_rows
    FROM (SELECT p, n, sum(p) OVER (ORDER BY s DESC) AS cp FROM (
        SELECT s, sum(y) AS p, sum(1 - y) AS n FROM (
            SELECT is_attack AS y, attack_probability + flow_duration / cast(100000 as double) AS s FROM pred WHERE event_id % 10 > 1)
        GROUP BY s))"""))
def ml_auc_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose score is null or NaN are counted, not ranked."""
    gap = F.col("event_id") % 10
    mixed = F.col("attack_probability") + F.col("flow_duration") / F.lit(100000.0)
    some = predictions(spark, sf_dir).select("is_attack", F.when(gap == 0, None).when(gap == 1, F.lit(float("nan")))
                                             .otherwise(mixed).alias("attack_probability"))
    return evaluate.auc_roc(some, slices=7).crossJoin(evaluate.unscored_rows(some))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with many distinct values, so that slicing is exercised."""
    mixed = F.col("attack_probability") + F.col("flow_duration") / F.lit(100000.0)
    return predictions(spark, sf_dir).select("is_attack", mixed.alias("attack_probability"))


@query("safe_ratio", """
    SELECT user_id, coalesce(round(cast(e as double) / nullif(c, 0), 5), 0) AS errors_per_click
    FROM (SELECT user_id, count(*) FILTER (event_type = 'error') AS e, count(*) FILTER (event_type = 'click') AS c
          FROM events GROUP BY user_id)""")
def safe_ratio_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_user = b.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
    )
    return per_user.select(
        "user_id", safe_ratio(F.col("errors"), F.col("clicks"), 5).alias("errors_per_click")
    )

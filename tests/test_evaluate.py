import random

import pytest
from helpers import plan_of
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowlake.operators import evaluate

SCHEMA = "is_attack int, attack_probability double"


def curve_of(spark, rows, resolution=0.1):
    points = evaluate.threshold_curve(spark.createDataFrame(rows, SCHEMA), resolution).collect()
    return {round(p.threshold, 5): p for p in points}


def test_curve_is_monotone_and_starts_with_everything(spark):
    rows = [(int(i % 3 == 0), i / 40) for i in range(3, 37)]
    curve = curve_of(spark, rows, 0.05)
    recalls = [curve[t].recall for t in sorted(curve)]
    assert all(a >= b for a, b in zip(recalls, recalls[1:])) and recalls[0] == 1.0


def test_equal_scores_share_a_point(spark):
    curve = curve_of(spark, [(1, 0.7), (0, 0.7), (0, 0.7), (1, 0.2)])
    assert (curve[0.7].precision, curve[0.7].recall) == (0.33333, 0.5)


def test_curve_without_positives_or_rows(spark):
    assert all(p.f1 == 0.0 and p.recall == 0.0 for p in curve_of(spark, [(0, 0.5), (0, 0.2)]).values())
    assert curve_of(spark, []) == {}


def test_curve_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(int(rng.random() < 0.3), rng.random()) for _ in range(500)]
    for t, point in curve_of(spark, rows, 0.05).items():
        hits = [y for y, p in rows if p >= t - 0.025]
        precision, recall = sum(hits) / len(hits), sum(hits) / sum(y for y, _ in rows)
        f1 = 2 * precision * recall / (precision + recall) if hits and sum(hits) else 0.0
        assert (point.precision, point.recall, point.f1) == pytest.approx((precision, recall, f1), abs=1e-5)


def test_best_threshold_prefers_the_higher_on_ties(spark):
    curve = spark.createDataFrame([(0.1, 0.8), (0.7, 0.9), (0.4, 0.9)], "threshold double, f1 double")
    assert evaluate.best_threshold(curve).first().threshold == 0.7


def predictions(spark, rows):
    return spark.createDataFrame(rows, "is_attack int, prediction double, attack_category string, attack_probability double")


def test_confusion_and_scores(spark):
    rows = [(1, 1.0, "DoS", 0.9)] * 3 + [(1, 0.0, "DoS", 0.2)] + [(0, 1.0, "Benign", 0.7)] * 2 + [(0, 0.0, "Benign", 0.1)] * 4
    for df in (predictions(spark, rows), evaluate.evaluation_cube(predictions(spark, rows))):
        got = evaluate.precision_recall_f1(df).first()
        assert (got.true_positive, got.false_positive, got.true_negative, got.false_negative) == (3, 2, 4, 1)
        assert (got["precision"], got.recall, got.f1) == (0.6, 0.75, 0.66667)
        cats = {r.attack_category: (r["count"], r.predicted_attack_count, r.detection_rate) for r in evaluate.category_detection(df).collect()}
        assert cats == {"Benign": (6, 2, 0.33333), "DoS": (4, 3, 0.75)}


def test_missing_cells_and_empty_input(spark):
    got = evaluate.precision_recall_f1(predictions(spark, [(0, 0.0, "Benign", 0.1)])).first()
    assert (got.true_positive, got.true_negative, got.f1) == (0, 1, 0.0)
    empty = evaluate.precision_recall_f1(predictions(spark, [])).first()
    assert (empty.true_positive, empty["precision"], empty.f1) == (0, 0.0, 0.0)
    nothing = evaluate.auc(predictions(spark, [])).first()
    assert nothing.auc_roc is None and nothing.auc_pr is None


def test_attack_rates(spark):
    df = spark.createDataFrame([(1, "train"), (0, "train"), (0, "train"), (1, "test")], "is_attack int, split string")
    assert evaluate.attack_rates(df).first().asDict() == {
        "test_rows": 1, "train_rows": 3, "attack_rate_test": 1.0, "attack_rate_train": 0.33333
    }
    none = evaluate.attack_rates(df.filter("split = 'train'")).first()
    assert none.test_rows == 0 and none.attack_rate_test == 0.0


def test_novel_rate(spark):
    df = spark.createDataFrame([(True, 1.0), (True, 0.0), (True, 1.0), (False, 1.0)], "novel boolean, prediction double")
    assert tuple(evaluate.novel_detection_rate(df).first()) == (3, 2, 0.66667)
    assert tuple(evaluate.novel_detection_rate(df.filter("NOT novel")).first()) == (0, 0, None)


@pytest.mark.parametrize("slices", [1, 7, 64])
@pytest.mark.parametrize("digits", [1, 12])
def test_auc_equals_the_exact_evaluator(spark, slices, digits):
    rng = random.Random(5)
    rows = []
    for _ in range(2000):
        y = int(rng.random() < 0.2)
        rows.append((y, round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2))), digits)))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    vectors = df.withColumn("rawPrediction", array_to_vector(F.array(1 - F.col("attack_probability"), "attack_probability")))
    got = evaluate.auc(df, slices=slices).first()
    for metric, value in (("areaUnderROC", got.auc_roc), ("areaUnderPR", got.auc_pr)):
        exact = BinaryClassificationEvaluator(labelCol="is_attack", metricName=metric, numBins=0).evaluate(vectors)
        assert value == pytest.approx(exact, abs=1e-5)


def test_running_totals_by_slices(spark):
    rng = random.Random(2)
    rows = [(float(i), rng.randrange(9)) for i in range(1000)]
    df = spark.createDataFrame(rows, "x double, n long").repartition(5)
    got = {r.x: r.cum_n for r in evaluate.descending_totals(df, "x", ["n"], 16).collect()}
    running = 0
    for x, n in reversed(rows):
        running += n
        assert got[x] == running


def test_slices_grow_with_the_points():
    assert [evaluate.slices_for(n) for n in (0, 100_000, 100_001, 10**9, 10**12)] == [1, 1, 2, 10**4, 10**7]


@pytest.mark.parametrize("slices", [1, 7, 64])
def test_rows_without_a_score_are_left_out(spark, slices):
    rng = random.Random(8)
    scored = [(int(rng.random() < 0.4), rng.random()) for _ in range(300)]
    gaps = [(i % 2, None if i % 3 else float("nan")) for i in range(60)]
    whole, bare = (spark.createDataFrame(rows, SCHEMA) for rows in (scored + gaps, scored))
    assert evaluate.auc(whole, slices=slices).first() == evaluate.auc(bare, slices=1).first()
    assert evaluate.unscored_rows(whole).first().unscored_rows == 60
    assert None not in curve_of(spark, scored[:5] + [(1, 0.5)])
    assert evaluate.threshold_curve(whole).collect() == evaluate.threshold_curve(bare).collect()


def test_auc_scans_once(spark, tmp_path):
    path = str(tmp_path / "scores")
    spark.range(500).selectExpr("cast(id % 2 AS int) AS is_attack", "id / 500 AS attack_probability").write.parquet(path)
    auc = evaluate.auc(spark.read.parquet(path))
    auc.collect()
    final = plan_of(auc).split("Initial Plan")[0]
    assert final.count("FileScan") == 1


def test_no_row_wise_window_on_one_task(spark):
    """Windows without a partition key only ever follow an aggregate."""
    df = spark.createDataFrame([(1, 0.5)], SCHEMA)
    plan = plan_of(evaluate.threshold_curve(df))
    assert "Window" in plan and "HashAggregate" in plan[plan.index("Window"):]

"""Model evaluation as aggregations.

Predictions are folded once into a small cube (actual, predicted, category,
novel, score bucket -> rows); every report but the AUCs is arithmetic on it.
Each function also takes raw predictions: `rows` is then the literal 1.

Column names: `is_attack`, `prediction`, `attack_category`,
`attack_probability`; `novel` marks rows whose label never occurs in training.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlake.functions import safe_ratio, snap
from flowlake.operators.running import running_totals

LABEL = "is_attack"
PREDICTED = "prediction"
CATEGORY = "attack_category"
SCORE = "attack_probability"
DIGITS = 5
BUCKET = "score_bucket"
ROWS = "rows"

# A running total over more ordered points than this is taken slice by slice.
SLICE_POINTS = 100_000


def _rows(df: DataFrame) -> Column:
    return F.col(ROWS) if ROWS in df.columns else F.lit(1)


def _total(condition: Column, rows: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, rows).otherwise(0)), F.lit(0))


def score_bucket(df: DataFrame, resolution: float = 0.01, output: str = BUCKET) -> DataFrame:
    return df.withColumn(output, snap(F.col(SCORE), resolution))


def evaluation_cube(predictions: DataFrame, resolution: float = 0.01) -> DataFrame:
    """Rows per (actual, predicted, category, novel, score bucket): at most a
    few thousand rows however many predictions there are."""
    keys = [c for c in (LABEL, PREDICTED, CATEGORY, "novel") if c in predictions.columns]
    return (
        score_bucket(predictions, resolution)
        .groupBy(*keys, BUCKET)
        .agg(F.count(F.lit(1)).alias(ROWS))
    )


def confusion_matrix(df: DataFrame) -> DataFrame:
    """One row; a cell that does not occur is 0. Laid out as a matrix it reads
    [[true_negative, false_positive], [false_negative, true_positive]]."""
    actual, predicted, rows = F.col(LABEL), F.col(PREDICTED), _rows(df)
    return df.agg(
        _total((actual == 0) & (predicted == 0), rows).alias("true_negative"),
        _total((actual == 0) & (predicted == 1), rows).alias("false_positive"),
        _total((actual == 1) & (predicted == 0), rows).alias("false_negative"),
        _total((actual == 1) & (predicted == 1), rows).alias("true_positive"),
    )


def _f1(precision: Column, recall: Column) -> Column:
    return safe_ratio(2 * precision * recall, precision + recall)


def precision_recall_f1(df: DataFrame) -> DataFrame:
    """The confusion row plus precision, recall and F1 (0.0 where undefined)."""
    cells = confusion_matrix(df)
    hit, wrong, missed = (F.col(c) for c in ("true_positive", "false_positive", "false_negative"))
    exact = cells.withColumns({
        "precision": safe_ratio(hit, hit + wrong),
        "recall": safe_ratio(hit, hit + missed),
    }).withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    return exact.withColumns({c: F.round(c, DIGITS) for c in ("precision", "recall", "f1")})


def category_detection(df: DataFrame) -> DataFrame:
    """Per category: rows, predicted positives and their share."""
    rows = _rows(df)
    return (
        df.groupBy(CATEGORY)
        .agg(
            F.sum(rows).cast("long").alias("count"),
            _total(F.col(PREDICTED) == 1, rows).alias("predicted_attack_count"),
        )
        .withColumn(
            "detection_rate",
            safe_ratio(F.col("predicted_attack_count"), F.col("count"), DIGITS, empty=None),
        )
        .orderBy(CATEGORY)
    )


def attack_rates(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and attack share of the test and the train split, from one scan."""
    rows = _rows(df)
    parts = ("test", "train")
    counts = df.agg(*[
        total
        for p in parts
        for total in (
            _total(F.col(split) == p, rows).alias(f"{p}_rows"),
            _total((F.col(split) == p) & (F.col(LABEL) == 1), rows).alias(f"_{p}_attacks"),
        )
    ])
    return counts.select(
        *[f"{p}_rows" for p in parts],
        *[
            safe_ratio(F.col(f"_{p}_attacks"), F.col(f"{p}_rows"), DIGITS).alias(f"attack_rate_{p}")
            for p in parts
        ],
    )


def novel_detection_rate(df: DataFrame) -> DataFrame:
    """Of the rows marked `novel`: how many, how many were caught, the share
    (null where there are none)."""
    rows = _rows(df)
    counts = df.agg(
        _total(F.col("novel"), rows).alias("novel_total"),
        _total(F.col("novel") & (F.col(PREDICTED) == 1), rows).alias("novel_caught"),
    )
    return counts.withColumn(
        "novel_attack_detection_rate",
        safe_ratio(F.col("novel_caught"), F.col("novel_total"), DIGITS, empty=None),
    )


def slices_for(points: int) -> int:
    """How many slices a running total over this many points should have. The
    result does not depend on it."""
    return max(1, -(-points // SLICE_POINTS))


def is_scored(score: Column) -> Column:
    """Whether a row has a rank at all: null and NaN scores have none. Such rows
    are left out of every ranked measure, whatever the number of slices."""
    return score.isNotNull() & ~F.isnan(score)


def descending_totals(
    points: DataFrame, order: str, sums: Sequence[str], slices: int | None = None
) -> DataFrame:
    """`cum_<c>`: sum of c over this and all points with a higher `order`.
    `order` must be unique and a double; points without one are left out.

    With one slice this is a plain running window, right for a bounded number
    of points. Otherwise the points are range-partitioned (into `slices`
    partitions if given) and every partition adds up its own stretch.
    """
    points = points.filter(is_scored(F.col(order)))
    if slices == 1:
        running = Window.orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
        return points.withColumns({f"cum_{c}": F.sum(c).over(running) for c in sums})
    return running_totals(points, [F.desc(order)], {f"cum_{c}": F.col(c) for c in sums}, slices)


def threshold_curve(df: DataFrame, resolution: float = 0.01) -> DataFrame:
    """Precision, recall and F1 when everything from a score bucket upwards
    counts as positive. A bucket t holds scores from t - resolution/2, so its
    point is not exactly "score >= t"."""
    bucketed = df if BUCKET in df.columns else score_bucket(df, resolution)
    points = bucketed.groupBy(BUCKET).agg(
        F.sum(_rows(df)).cast("long").alias("n"),
        _total(F.col(LABEL) == 1, _rows(df)).alias("pos"),
    )
    points = points.filter(is_scored(F.col(BUCKET)))
    slices = slices_for(int(1 / resolution))
    totals = descending_totals(points, BUCKET, ["n", "pos"], slices)
    # All positives: the curve's last running total.
    everything = points.agg(F.sum("pos").alias("pos")).scalar() if slices > 1 else F.max("cum_pos").over(
        Window.partitionBy()
    )
    precision = safe_ratio(F.col("cum_pos"), F.col("cum_n"))
    recall = safe_ratio(F.col("cum_pos"), F.col("_all"))
    return (
        totals.withColumn("_all", everything)
        .select(
            F.round(BUCKET, DIGITS).alias("threshold"),
            precision.alias("_p"),
            recall.alias("_r"),
        )
        .select(
            "threshold",
            F.round("_p", DIGITS).alias("precision"),
            F.round("_r", DIGITS).alias("recall"),
            F.round(_f1(F.col("_p"), F.col("_r")), DIGITS).alias("f1"),
        )
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """Curve point of the highest F1; among equals the highest threshold."""
    return curve.orderBy(F.desc("f1"), F.desc("threshold")).limit(1)


def _ranked(df: DataFrame, score: str, label: str, slices: int | None) -> DataFrame:
    """Per distinct score: positives, negatives and their totals from the top.
    Folding by score first means a hot score costs one row per task, and leaves
    scores that tell all points apart."""
    rows = _rows(df)
    value = F.col(score).cast("double")
    points = df.filter(is_scored(value)).groupBy(value.alias("score")).agg(
        _total(F.col(label) == 1, rows).alias("pos"),
        _total(F.col(label) == 0, rows).alias("neg"),
    ).filter("pos + neg > 0")
    return descending_totals(points, "score", ["pos", "neg"], slices)


def auc(df: DataFrame, score: str = SCORE, label: str = LABEL, slices: int | None = None) -> DataFrame:
    """Exact areas under the ROC curve and under precision over recall, null
    where a class is missing. Trapezoids over the distinct scores from the top,
    the second curve starting at (0, first precision). Rows without a score are
    left out (`unscored_rows` counts them). The previous point needs
    no lag: it is the running total minus the point's own share."""
    pos, neg, cum_pos, cum_neg = (F.col(c).cast("double") for c in ("pos", "neg", "cum_pos", "cum_neg"))
    here = safe_ratio(cum_pos, cum_pos + cum_neg)
    before = F.coalesce(safe_ratio(cum_pos - pos, cum_pos - pos + cum_neg - neg, empty=None), here)
    # In doubles: the product of two row counts outgrows a long.
    areas = _ranked(df, score, label, slices).agg(
        F.sum(neg * (2 * cum_pos - pos) / 2.0).alias("_roc"),
        F.sum(pos * (here + before) / 2.0).alias("_pr"),
        F.sum(pos).alias("_p"),
        F.sum(neg).alias("_n"),
    )
    return areas.select(
        F.round(F.try_divide("_roc", F.col("_p") * F.col("_n")), DIGITS).alias("auc_roc"),
        F.round(F.try_divide("_pr", "_p"), DIGITS).alias("auc_pr"),
    )


def unscored_rows(df: DataFrame, score: str = SCORE) -> DataFrame:
    """Rows that the ranked measures leave out."""
    return df.agg(_total(~is_scored(F.col(score).cast("double")), _rows(df)).alias("unscored_rows"))


def auc_roc(df: DataFrame, score: str = SCORE, label: str = LABEL, slices: int | None = None) -> DataFrame:
    return auc(df, score, label, slices).select("auc_roc")


def auc_pr(df: DataFrame, score: str = SCORE, label: str = LABEL, slices: int | None = None) -> DataFrame:
    return auc(df, score, label, slices).select("auc_pr")

import math
import random
from collections import Counter

import pytest
from helpers import connection, connections, flow, flows, long_report, plan_of
from pyspark.sql import functions as F

from flowlake.functions import map_lookup, safe_ratio
from flowlake.operators import clean, quality
from flowlake.specs import CICIDS2017, NSL_KDD


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_labels_of_connections(spark):
    raw = connections(spark, [
        connection("train", attack_type=t) for t in ("normal", "neptune", "satan", "guess_passwd", "rootkit", "brand_new")
    ] + [connection("train", attack_type=None)])
    got = {r.attack_type: (r.is_attack, r.attack_category) for r in clean.clean(raw, NSL_KDD).collect()}
    assert got == {
        "normal": (0, "Benign"), "neptune": (1, "DoS"), "satan": (1, "Probe/Scan"),
        "guess_passwd": (1, "Brute Force"), "rootkit": (1, "Privilege Escalation"),
        "brand_new": (1, "Other"), None: (1, "Other"),
    }


def test_labels_of_flows(spark):
    labels = {
        "BENIGN": "Benign", "DDoS": "DoS", "PortScan": "Probe/Scan", "Heartbleed": "Other", "Bot": "Botnet",
        "Web Attack – XSS": "Web Attack", "Web Attack \x96 XSS": "Web Attack", "Unseen": "Other",
    }
    raw = flows(spark, [flow("monday", label=x) for x in labels])
    got = {r.label: r for r in clean.clean(raw, CICIDS2017).collect()}
    assert {k: r.attack_category for k, r in got.items()} == labels
    assert {k for k, r in got.items() if r.is_attack == 0} == {"BENIGN"}


def test_duplicates_collapse_within_a_split_only(spark):
    raw = connections(spark, [connection("train")] * 3 + [connection("test")])
    assert Counter(r.split for r in clean.clean(raw, NSL_KDD).collect()) == {"train": 1, "test": 1}


def test_difficulty_is_no_key_and_its_smallest_survives(spark):
    rows = [connection("train", difficulty=d) for d in (21, 5, 14)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        (got,) = clean.clean(connections(spark, rows).repartition(3), NSL_KDD).collect()
        assert got.difficulty == 5


def test_flow_dedup_prefers_train_whatever_the_order(spark):
    rows = [flow("friday_ddos"), flow("wednesday"), flow("monday"), flow("friday_ddos", flow_duration=7)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = {r.flow_duration: (r.source_day, r.split) for r in clean.clean(flows(spark, rows).repartition(3), CICIDS2017).collect()}
        assert got == {1000: ("monday", "train"), 7: ("friday_ddos", "test")}


def test_undeclared_source_is_an_error(spark):
    raw = flows(spark, [flow("monday")]).withColumn("source_day", F.lit("sunday"))
    with pytest.raises(Exception, match="undeclared source: sunday"):
        clean.clean(raw, CICIDS2017).collect()


def test_negative_and_null_durations_go(spark):
    raw = flows(spark, [flow("monday", flow_duration=d) for d in (-1, 0, 5, None)])
    assert sorted(r.flow_duration for r in clean.clean(raw, CICIDS2017).collect()) == [0, 5]


def test_nonfinite_rates(spark):
    values = [float("inf"), float("-inf"), float("nan"), 500.0, None]
    raw = flows(spark, [flow("monday", flow_duration=i, flow_bytes_per_s=v) for i, v in enumerate(values)])
    got = [r.flow_bytes_per_s for r in clean.clean_flows(raw, CICIDS2017).orderBy("flow_duration").collect()]
    assert got == [-1.0, -1.0, -1.0, 500.0, None]
    filled = clean.clean_flows(raw, CICIDS2017, null_as_nonfinite=True).orderBy("flow_duration").collect()
    assert filled[4].flow_bytes_per_s == -1.0


def test_rows_that_differ_only_in_nan_and_inf_are_copies(spark):
    raw = flows(spark, [flow("monday", flow_bytes_per_s=v) for v in (float("inf"), float("nan"))])
    assert clean.clean(raw, CICIDS2017).count() == 1


def test_dedup_plans_without_sort(spark):
    raw = flows(spark, [flow("monday")])
    for df in (clean.clean(raw, CICIDS2017), clean.clean(connections(spark, [connection("train")]), NSL_KDD)):
        assert "SortAggregate" not in plan_of(df) and "HashAggregate" in plan_of(df)


def test_dedup_first_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.choice([None, "x", "y"]), rng.randrange(5)) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, s string, n int").repartition(5)
    first = lambda r: ((r[1] is not None, r[1] or ""), r[2])  # nulls first
    expected = {k: min((r for r in rows if r[0] == k), key=first) for k in "abc"}
    got = {r.k: tuple(r) for r in clean.dedup_first(df, ["k"], ["s", "n"]).collect()}
    assert got == expected


def test_hot_key_sends_one_row_per_task(spark):
    """A key with most of the rows is folded before the shuffle."""
    df = spark.range(0, 40_000, numPartitions=4).selectExpr("if(id % 10 < 9, 0, id) AS k", "cast(id AS int) AS d")
    folded = clean.dedup_smallest(df, ["k"], "d")
    assert folded.count() == 1 + 4000 and folded.filter("k = 0").first().d == 0
    plan = plan_of(folded)
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")


def test_dq_report_of_connections(spark):
    raw = connections(spark, [
        *[connection("train")] * 3, connection("train", attack_type="neptune"),
        connection("test"), connection("test", attack_type="odd"), connection("test", attack_type="odd", difficulty=1),
        connection("test", attack_type="saint"),
    ])
    assert long_report(quality.dq_stats(raw, NSL_KDD)) == {
        ("raw_row_counts", "train"): 4, ("raw_row_counts", "test"): 4, ("total_raw_rows", ""): 8,
        ("duplicates_removed", ""): 3, ("final_cleaned_rows", ""): 5,
        ("distinct_attack_types", "train"): 2, ("distinct_attack_types", "test"): 3,
        ("novel_attack_types_in_test_not_in_train", "odd"): 2,
        ("novel_attack_types_in_test_not_in_train", "saint"): 1,
        ("attack_types_with_no_category_mapping", "odd"): 2,
    }


def test_dq_report_of_flows(spark):
    inf, nan = float("inf"), float("nan")
    raw = flows(spark, [
        flow("monday", flow_duration=-1, flow_bytes_per_s=inf), flow("monday", flow_duration=None),
        flow("monday", flow_bytes_per_s=inf), flow("friday_ddos", flow_bytes_per_s=nan),
        flow("wednesday", flow_packets_per_s=nan, label="odd"), flow("monday", bwd_packets_per_s=None),
    ])
    got = long_report(quality.dq_stats(raw, CICIDS2017, ["monday", "wednesday", "friday_ddos"]))
    assert got == {
        ("raw_row_counts_by_day", "monday"): 4, ("raw_row_counts_by_day", "wednesday"): 1,
        ("raw_row_counts_by_day", "friday_ddos"): 1, ("total_raw_rows", ""): 6,
        ("negative_duration_rows_dropped", ""): 1, ("null_duration_rows_dropped", ""): 1,
        ("rate_column_infinity_or_nan_imputed", "flow_bytes_per_s"): 2,
        ("rate_column_infinity_or_nan_imputed", "flow_packets_per_s"): 1,
        ("rate_column_infinity_or_nan_imputed", "fwd_packets_per_s"): 0,
        ("rate_column_infinity_or_nan_imputed", "bwd_packets_per_s"): 0,
        ("rate_column_null", "flow_bytes_per_s"): 0, ("rate_column_null", "flow_packets_per_s"): 0,
        ("rate_column_null", "fwd_packets_per_s"): 0, ("rate_column_null", "bwd_packets_per_s"): 1,
        ("duplicates_removed", ""): 1, ("final_cleaned_rows", ""): 3,
        ("labels_with_no_category_mapping", "odd"): 1,
    }
    cleaned = clean.clean(raw, CICIDS2017).count()
    assert cleaned == got[("final_cleaned_rows", "")]


def test_report_is_one_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    flows(spark, [flow("monday"), flow("friday_ddos")]).write.parquet(path)
    plan = plan_of(quality.dq_stats(spark.read.parquet(path), CICIDS2017))
    assert plan.count("FileScan") == 1


def test_label_sets(spark):
    df = spark.createDataFrame(
        [("a", "train"), ("a", "test"), ("b", "test"), ("b", "test"), (None, "test"), ("c", "train")],
        "label string, split string",
    )
    assert {r.label for r in quality.novel_labels(df, "label").collect()} == {"b", None}
    assert Counter(r.label for r in quality.novel_rows(df, "label").collect()) == {"b": 2, None: 1}
    assert {r.label for r in quality.unmapped_labels(df, "label", {"a": "x"}).collect()} == {"b", "c", None}
    assert {r.split: r.distinct_labels for r in quality.count_distinct_labels(df, "label").collect()} == {"train": 2, "test": 3}
    # A null seen in both splits is not novel.
    both = df.union(spark.createDataFrame([(None, "train")], df.schema))
    assert {r.label for r in quality.novel_labels(both, "label").collect()} == {"b"}


def test_lists_are_computed_once(spark):
    runs = spark.sparkContext.accumulator(0)
    df = spark.range(1000).selectExpr("id AS k", "'test' AS split")
    watched = spark.createDataFrame(df.rdd.map(lambda r: (runs.add(1), tuple(r))[1]), df.schema)
    for most, kind in ((1000, "LocalTableScan"), (999, "FileScan")):
        before = runs.value
        found = quality.bounded(watched, most)
        assert found.count() == 1000 and found.distinct().count() == 1000
        assert runs.value == before + 1000 and kind in plan_of(found)


def test_long_lists_are_filtered_by_bitmaps_and_joined(spark, monkeypatch):
    monkeypatch.setattr(quality, "LITERAL_ROWS", 100)
    monkeypatch.setattr(quality.bounded, "__defaults__", (100,))
    rows = [(i % 5000, i) for i in range(20_000)] + [(None, -1)]
    df = spark.createDataFrame(rows, "k long, i long").repartition(4)
    listed = spark.createDataFrame([(i,) for i in range(0, 9000, 3)] + [(None,), (3,)], "v long")
    got = quality.rows_in_list(df, "k", listed)
    assert sorted(r.i for r in got.collect()) == [-1, *(i for i in range(20_000) if i % 5000 % 3 == 0)]
    plan = plan_of(got)
    assert "bitmap_construct_agg" in plan and got.columns == ["k", "i"]
    # Few rows without a partner are left, however few bits there are none is lost.
    left = quality.may_occur(df, "k", listed).count()
    assert 6668 < left < 8500
    assert quality.may_occur(df, "k", listed, bits=32_768).filter("k % 3 = 0 OR k IS NULL").count() == got.count()
    # Another type: no filter, the same rows.
    short = quality.rows_in_list(df, "k", listed.selectExpr("cast(v AS int) AS v"))
    assert short.count() == got.count() and "bitmap" not in plan_of(short)


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("en", 1, 0), (None, 1, 4), ("xx", 0, 0)], "k string, a int, b int")
    got = df.select(
        map_lookup(F.col("k"), {"en": "English"}, "?").alias("m"),
        map_lookup(F.col("k"), {}, "?").alias("e"),
        safe_ratio(F.col("a"), F.col("b")).alias("r"),
        safe_ratio(F.col("a"), F.col("b"), empty=None).alias("n"),
    ).collect()
    assert [tuple(r) for r in got] == [("English", "?", 0.0, None), ("?", "?", 0.25, 0.25), ("?", "?", 0.0, None)]
    assert not math.isnan(got[0].r)


@pytest.mark.parametrize("nulls", [False, True])
def test_report_with_a_stored_cleaned_table_is_the_same(spark, tmp_path, nulls):
    """With the cleaned table at hand the raw rows need no wide shuffle."""
    rng = random.Random(4)
    rates = [float("inf"), float("nan"), 1.0, None]
    flow_rows = [
        flow(rng.choice(["monday", "wednesday", "friday_ddos"]), flow_duration=rng.choice([-1, 0, 1, None]),
             flow_bytes_per_s=rng.choice(rates), label=rng.choice(["BENIGN", "odd", None]))
        for _ in range(150)
    ]
    connection_rows = [
        connection(rng.choice(["train", "test"]), duration=float(rng.randrange(3)), difficulty=rng.randrange(9),
                   attack_type=rng.choice(["normal", "saint", "odd"]))
        for _ in range(100)
    ]
    for spec, raw in ((CICIDS2017, flows(spark, flow_rows)), (NSL_KDD, connections(spark, connection_rows))):
        path = str(tmp_path / spec.name)
        clean.clean(raw, spec, nulls).write.parquet(path)
        alone = quality.dq_stats(raw, spec, None, nulls)
        stored = quality.dq_stats(raw, spec, None, nulls, spark.read.parquet(path))
        assert long_report(stored) == long_report(alone)
        assert long_report(alone)[("duplicates_removed", "")] > 0
        wide = ("hashpartitioning(destination_port#", "hashpartitioning(duration#")
        assert not any(w in plan_of(stored) for w in wide)
        assert any(w in plan_of(alone) for w in wide)


def test_empty_raw_table_reports_zeros(spark):
    report = quality.dq_stats(flows(spark, [flow("monday")]).filter("false"), CICIDS2017).collect()
    assert report and all(r.value == 0 for r in report)


def test_empty_input_gives_zero_lines(spark):
    report = {(r.metric, r.key): r.value for r in quality.dq_stats(connections(spark, [connection("train")]).limit(0), NSL_KDD).collect()}
    assert report[("total_raw_rows", "")] == report[("raw_row_counts", "test")] == 0

import json
import random

import pyarrow.parquet as pq
import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from flowlake.operators import serve
from flowlake.sources import sinks

CONNECTION_SCHEMA = """protocol_type string, service string, duration double, src_bytes double, dst_bytes double,
    is_attack int, attack_category string, prediction double, attack_probability double, rule_flags string, split string"""
FLOW_SCHEMA = """destination_port int, flow_duration double, total_length_of_fwd_packets double,
    total_length_of_bwd_packets double, is_attack int, attack_category string, prediction double,
    attack_probability double, rule_flags string, split string, source_day string"""


@pytest.fixture(scope="module")
def scored_connections(spark):
    return spark.createDataFrame([
        ("icmp", "eco_i", 31.5, 8.0, 1024.0, 0, "Benign", 1.0, 0.61, "land_attack,high_error_rate", "train"),
        ("udp", "domain_u", 2.0, 44.0, 0.0, 1, "DoS", 0.0, 0.33, "", "test"),
    ], CONNECTION_SCHEMA)


@pytest.fixture(scope="module")
def scored_flows(spark):
    return spark.createDataFrame([
        (8080, 77.0, 12.0, 9000.0, 0, "Benign", 1.0, 0.58, "asymmetric_flow", "test", "friday_ddos"),
        (22, 640000.0, 5.0, 0.0, 1, "DoS", 0.0, 0.44, "", "train", "wednesday"),
    ], FLOW_SCHEMA)


def test_connections_on_the_common_schema(scored_connections):
    out = serve.project_common_schema(scored_connections, "nsl_kdd", ["protocol_type", "service"])
    assert tuple(out.columns) == serve.COMMON_COLUMNS
    row = out.filter("attack_category_actual = 'DoS'").first()
    assert (row.protocol, row.source_day, row.duration, row.predicted_label) == ("udp", None, 2.0, 0)
    assert json.loads(row.raw_features) == {"protocol_type": "udp", "service": "domain_u"}
    assert dict(out.dtypes)["source_day"] == "string" and dict(out.dtypes)["predicted_label"] == "int"


def test_flows_on_the_common_schema(scored_flows):
    rows = {r.attack_category_actual: r for r in serve.project_common_schema(scored_flows, "cicids2017", ["flow_duration"]).collect()}
    assert (rows["Benign"].bytes_sent, rows["Benign"].bytes_received, rows["Benign"].duration) == (12.0, 9000.0, 77.0)
    assert rows["Benign"].protocol is None and rows["DoS"].source_day == "wednesday"


def test_union_of_both(scored_connections, scored_flows):
    both = serve.union_datasets(
        serve.project_common_schema(scored_connections, "nsl_kdd", ["duration"]),
        serve.project_common_schema(scored_flows, "cicids2017", ["destination_port"]),
    )
    assert {r.dataset_source for r in both.collect()} == {"nsl_kdd", "cicids2017"} and both.count() == 4


def test_ids_are_prefixed_unique_short_and_stable(scored_connections):
    def ids(df, key=None):
        return sorted(r.flow_id for r in serve.project_common_schema(df, "nsl_kdd", ["service"], key).collect())

    for key in (None, ["service"]):
        once = ids(scored_connections, key)
        assert once == ids(scored_connections.repartition(7), key) == ids(scored_connections, key)
        assert len(set(once)) == 2 and all(x.startswith("nsl_kdd-") and len(x) <= 64 for x in once)


def test_key_hash_is_injective(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "bc"), ("", "bc"), ("~", "bc"), ("a", None), ("1:a", "2:bc")]
    df = spark.createDataFrame(rows, "x string, y string").withColumn("id", serve.flow_id("d", ["x", "y"]))
    assert df.select("id").distinct().count() == len(rows)


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_copies_get_ids_of_their_own(spark, chunk):
    df = spark.range(100).selectExpr("if(id < 60, 'hot', cast(id % 4 AS string)) AS x").withColumn("id", serve.flow_id("d", ["x"]))
    rows = serve.number_copies(df, "id", chunk).collect()
    assert len(rows) == 100 and len({r.id for r in rows}) == 100
    assert sum(r.x == "hot" for r in rows) == 60
    base = df.filter("x = 'hot'").first().id
    assert {r.id for r in rows if r.x == "hot"} == {base} | {f"{base}.{i}" for i in range(1, 60)}


def test_json_leaves_out_nulls_and_quotes_nonfinite(spark):
    df = spark.createDataFrame([(None, float("nan"), 1.5)], "a string, b double, c double")
    assert df.select(serve.json_payload(["a", "b", "c"]).alias("j")).first().j == '{"b":"NaN","c":1.5}'


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        dataset = rng.choice(["nsl_kdd", "cicids2017"])
        rows.append((
            f"{dataset}-{rng.getrandbits(128):032x}", dataset, rng.choice(["train", "test"]), rng.randrange(2),
            rng.choice(["Benign", "DoS", "Other"]), rng.randrange(2), rng.random(), f"2024-01-0{rng.randrange(1, 3)} 00:00:00",
        ))
    return spark.createDataFrame(rows, """flow_id string, dataset_source string, split string, is_attack_actual int,
        attack_category_actual string, predicted_label int, attack_probability double, at string""").selectExpr(
        "* EXCEPT (at)", "cast(at AS timestamp) AS scored_at").cache()


@pytest.mark.parametrize("filters", [
    {}, {"dataset": "nsl_kdd"}, {"split": "test"}, {"predicted_label": 0}, {"attack_category": "DoS"},
    {"dataset": "", "split": "", "attack_category": ""},
    {"dataset": "cicids2017", "split": "train", "predicted_label": 1, "attack_category": "Other"},
])
def test_filters_and_pages(table, filters):
    names = {"dataset": "dataset_source", "attack_category": "attack_category_actual"}
    given = {names.get(k, k): v for k, v in filters.items() if v not in ("", None)}
    wanted = [r for r in table.collect() if all(r[k] == v for k, v in given.items())]
    wanted.sort(key=lambda r: (-r.scored_at.timestamp(), r.flow_id))
    page = serve.flows_page(table, limit=15, offset=10, **filters)
    assert page.total.first().total == len(wanted)
    assert [r.flow_id for r in page.items.collect()] == [r.flow_id for r in wanted[10:25]]


def test_page_bounds(table):
    for bad in ({"limit": 0}, {"limit": 2001}, {"offset": -1}, {"dataset": "x"}, {"predicted_label": 2}):
        with pytest.raises(ValueError):
            serve.flows_page(table, **bad)
    assert serve.flows_page(table, offset=100_000 - 50).items.count() == 0
    assert "TakeOrderedAndProject" in plan_of(serve.shallow_page_keys(table, 50, 0))


@pytest.mark.parametrize("offset, limit", [(0, 5), (123, 40), (395, 50), (400, 3), (999, 3)])
def test_deep_pages_are_the_same_pages(table, monkeypatch, offset, limit):
    expected = [r.flow_id for r in serve.flows_page(table, limit, offset).items.collect()]
    monkeypatch.setattr(serve, "DEEP_PAGE_ROWS", 0)
    assert "TakeOrdered" not in plan_of(serve.deep_page_keys(table, limit, offset))
    assert [r.flow_id for r in serve.flows_page(table, limit, offset).items.collect()] == expected


def test_stored_table_is_sorted_for_lookups(spark, table, tmp_path):
    path = str(tmp_path / "served")
    sinks.write_partitioned(table, path, by=("dataset_source", "split"), lookup_column="flow_id")
    files = list((tmp_path / "served").rglob("*.parquet"))
    assert files
    for file in files:
        ids = pq.ParquetFile(file).read(columns=["flow_id"]).column("flow_id").to_pylist()
        assert ids == sorted(ids)
    back = spark.read.parquet(path)
    page = serve.flows_page(back, limit=20, offset=30, dataset="nsl_kdd", split="test").items
    assert page.count() == 20
    scan = [x for x in plan_of(page).splitlines() if "FileScan" in x][-1]
    assert "PartitionFilters: [isnotnull(dataset_source" in scan and "GreaterThanOrEqual(flow_id" in scan
    wanted = table.first().flow_id
    assert "EqualTo(flow_id" in plan_of(serve.lookup_by_id(back, wanted))
    assert serve.lookup_by_id(back, wanted).count() == 1


def test_lookup(table):
    some = table.first().flow_id
    assert [r.flow_id for r in serve.lookup_by_id(table, some).collect()] == [some]
    assert serve.lookup_by_id(table, "missing").count() == 0


def test_statistics(table):
    rows = table.collect()
    mine = [r for r in rows if r.dataset_source == "nsl_kdd"]
    summary = serve.predicted_attack_rate(serve.summary_stats(table, "nsl_kdd")).first()
    assert summary.total_flows == len(mine)
    assert summary.predicted_attack_count == sum(r.predicted_label for r in mine)
    assert summary.predicted_attack_rate == pytest.approx(summary.predicted_attack_count / len(mine))
    assert serve.summary_stats(table.filter("false"), "nsl_kdd").count() == 0
    with pytest.raises(ValueError):
        serve.summary_stats(table, "x")
    stats = serve.dataset_stats(table).collect()
    assert [(r.dataset_source, r.split) for r in stats] == sorted((r.dataset_source, r.split) for r in stats)
    assert sum(r.total_flows for r in stats) == 400
    cats = serve.category_breakdown(table).collect()
    assert [r.predicted_attack_count for r in cats] == sorted((r.predicted_attack_count for r in cats), reverse=True)
    assert sum(r.total_flows for r in serve.category_breakdown(table, "nsl_kdd").collect()) == len(mine)


def test_category_ties_are_ordered_by_name(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "attack_category_actual string, predicted_label int")
    assert [r.attack_category for r in serve.category_breakdown(df).collect()] == ["c", "a", "b"]


def test_label_display(spark):
    df = serve.add_label_display(spark.createDataFrame([(1,), (0,), (None,)], "predicted_label int"))
    assert [r.label_display for r in df.collect()] == ["Attack", "Benign", None]


def test_stamp(spark):
    stamped = serve.stamp(spark.range(2), "2024-01-01 00:00:00").select(F.count_distinct("scored_at")).first()
    assert stamped[0] == 1


def test_pages_in_another_time_zone(spark, table):
    expected = [r.flow_id for r in serve.flows_page(table, limit=30, offset=5).items.collect()]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [r.flow_id for r in serve.flows_page(table, limit=30, offset=5).items.collect()] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("deep", [False, True])
def test_pages_keep_rows_with_nulls(spark, monkeypatch, deep):
    if deep:
        monkeypatch.setattr(serve, "DEEP_PAGE_ROWS", 0)
    rows = [(f"nsl_kdd-{i:032x}" if i % 5 else None, "nsl_kdd", None if i % 3 == 0 else i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "flow_id string, dataset_source string, t int").select(
        "flow_id", "dataset_source", F.timestamp_seconds("t").alias("scored_at"))
    page = serve.flows_page(df, limit=20)
    assert page.items.count() == page.total.first().total == 20


def test_lookup_prunes_the_other_datasets(spark, tmp_path):
    path = str(tmp_path / "served")
    spark.createDataFrame([("a-1", "a"), ("b-1", "b")], "flow_id string, dataset_source string").write.partitionBy("dataset_source").parquet(path)
    found = serve.lookup_by_id(spark.read.parquet(path), "b-1")
    assert "PartitionFilters: [isnotnull(dataset_source" in plan_of(found) and found.count() == 1

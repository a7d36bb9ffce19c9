import json
from collections import Counter
from dataclasses import replace

import pytest
from helpers import connection, csv_line, flow, long_report, plan_of
from pyspark.sql import functions as F

from flowlake.operators import clean, quality
from flowlake.plans import workflow
from flowlake.sources import readers, sinks
from flowlake.sources.schema import CORRUPT, raw_schema, schema_from_columns
from flowlake.specs import CICIDS2017, NSL_KDD, SPECS, spec_for


def test_schema_types_and_positions():
    connection_schema, flow_schema = raw_schema(NSL_KDD), raw_schema(CICIDS2017)
    assert len(connection_schema) == 43 and len(flow_schema) == 79
    kinds = {f.name: f.dataType.simpleString() for f in connection_schema}
    assert [k for k, v in kinds.items() if v == "string"] == ["protocol_type", "service", "flag", "attack_type"]
    assert kinds["difficulty"] == "int" and kinds["duration"] == "double"
    kinds = {f.name: f.dataType.simpleString() for f in flow_schema}
    assert (kinds["destination_port"], kinds["flow_duration"], kinds["label"]) == ("int", "bigint", "string")
    assert flow_schema.fieldNames()[55] == "fwd_header_length_dup"
    assert schema_from_columns(["a"], strings=["a"]).simpleString() == "struct<a:string>"


def test_spec_counts():
    assert len(NSL_KDD.numeric) == 38 and len(CICIDS2017.numeric) == 77
    assert len(NSL_KDD.taxonomy) == 40 and len(CICIDS2017.taxonomy) == 18
    assert set(SPECS) == {"nsl_kdd", "cicids2017"}
    with pytest.raises(ValueError, match="no dataset .other."):
        spec_for("other")


def test_headerless_csv(spark, tmp_path):
    path = tmp_path / "train.txt"
    path.write_text("\n".join(csv_line(NSL_KDD, connection(duration=float(i))) for i in range(3)))
    df = readers.read_headerless_csv(spark, str(path), raw_schema(NSL_KDD), split="train")
    assert df.count() == 3
    assert {r.split for r in df.collect()} == {"train"}
    assert sorted(r.duration for r in df.collect()) == [0.0, 1.0, 2.0]


def test_positional_csv_ignores_duplicate_padded_header(spark, tmp_path):
    header = [f" H{i % 40}" for i in range(79)]
    row = flow(flow_bytes_per_s="Infinity", flow_packets_per_s="NaN", fwd_header_length_dup=7.0)
    path = tmp_path / "day.csv"
    path.write_text(",".join(header) + "\n" + csv_line(CICIDS2017, row) + "\n")
    df = readers.read_positional_csv(
        spark, str(path), raw_schema(CICIDS2017), drop=CICIDS2017.dropped_columns, source_day="friday_ddos"
    )
    (got,) = df.collect()
    assert "fwd_header_length_dup" not in df.columns
    assert got.destination_port == 80 and got.label == "BENIGN" and got.source_day == "friday_ddos"
    assert got.flow_bytes_per_s == float("inf") and got.flow_packets_per_s != got.flow_packets_per_s


def test_malformed_lines_are_kept_for_counting(spark, tmp_path):
    good = csv_line(NSL_KDD, connection())
    path = tmp_path / "bad.txt"
    path.write_text("\n".join([good, "1,tcp", good + ",99", good]))
    df = readers.read_headerless_csv(spark, str(path), raw_schema(NSL_KDD), keep_corrupt=True)
    assert df.cache().filter(df[CORRUPT].isNotNull()).count() == 2
    df.unpersist()


def test_registry_fails_fast_and_tags(spark, tmp_path):
    with pytest.raises(ValueError, match="no source .sunday."):
        readers.read_registry(spark, CICIDS2017, str(tmp_path), ["monday", "sunday"])
    for day in ("monday", "friday_ddos"):
        (tmp_path / CICIDS2017.files[day]).write_text(
            ",".join(CICIDS2017.columns) + "\n" + csv_line(CICIDS2017, flow()) + "\n"
        )
    rows = readers.read_registry(spark, CICIDS2017, str(tmp_path), ["monday", "friday_ddos"]).collect()
    assert {(r.source_day, r.split) for r in rows} == {("monday", "train"), ("friday_ddos", "test")}


def test_registry_is_one_scan(spark, tmp_path):
    """Many files, with names that paths encode, some of them folders of parts."""
    files = {f"day {i}%+é": f"Day-{i} 100%+é.csv" for i in range(20)}
    spec = replace(CICIDS2017, files=files, train_sources=tuple(files)[:7])
    line = lambda i: csv_line(CICIDS2017, flow(destination_port=i)) + "\n"
    for i, name in enumerate(files.values()):
        head = ",".join(CICIDS2017.columns) + "\n"
        if i % 3:
            (tmp_path / name).write_text(head + line(i))
        else:
            (tmp_path / name).mkdir()
            for part in range(2):
                (tmp_path / name / f"part-{part}.csv").write_text(head + line(i))
    df = readers.read_registry(spark, spec, str(tmp_path), keys=list(files))
    assert plan_of(df).count("FileScan csv") == 1
    got = Counter((r.source_day, r.split, r.destination_port) for r in df.collect())
    assert got == {(key, "train" if i < 7 else "test", i): 1 if i % 3 else 2 for i, key in enumerate(files)}
    few = readers.read_registry(spark, spec, str(tmp_path), keys=list(files)[:2], keep_corrupt=True)
    assert [r[CORRUPT] for r in few.collect()] == [None] * 3 and few.columns == [*df.columns[:-2], CORRUPT, "split", "source_day"]
    twice = replace(spec, files={**files, "again": files["day 0%+é"]})
    with pytest.raises(ValueError, match="share a file"):
        readers.read_registry(spark, twice, str(tmp_path), keys=["again", "day 0%+é"])


def test_raw_files_are_read_once(spark, tmp_path, monkeypatch):
    """Cleaning stage: every raw row is read by one job, whatever is reported."""
    good = csv_line(NSL_KDD, connection())
    other = csv_line(NSL_KDD, connection(attack_type="neptune"))
    (tmp_path / NSL_KDD.files["train"]).write_text("\n".join([good, "1,tcp", good, other]))
    (tmp_path / NSL_KDD.files["test"]).write_text(good + ",99\n")
    counted = []
    original = readers.read_registry
    monkeypatch.setattr(readers, "read_registry", lambda *a, **k: counted.append(1) or original(*a, **k))
    layout = workflow.Layout(str(tmp_path / "lake"), NSL_KDD.name)
    workflow.clean_stage(spark, NSL_KDD, str(tmp_path), layout)
    assert counted == [1]
    report = {(r.metric, r.key): r.value for r in readers.read_report(spark, layout.quality_report).collect()}
    assert report[("malformed_rows", "")] == 2 and report[("total_raw_rows", "")] == 5
    assert report[("final_cleaned_rows", "")] == readers.read_table(spark, layout.cleaned).count() == 4
    status = {r.key: (r.value, r.text) for r in readers.read_report(spark, layout.path("expected_rows")).collect()}
    assert status == {"train": (4.0, "mismatch"), "test": (1.0, "mismatch")}


def test_default_sources(spark, tmp_path):
    assert CICIDS2017.default_sources == ("monday", "wednesday", "friday_ddos")
    assert readers.source_file(NSL_KDD, "raw", "test") == "raw/KDDTest+.txt"


def test_rows_to_frame(spark):
    df = readers.rows_to_frame(spark, [{"a": 1.0}, {"b": "x"}], "a DOUBLE, b STRING")
    assert [tuple(r) for r in df.collect()] == [(1.0, None), (None, "x")]
    with pytest.raises(ValueError, match="Unknown field"):
        readers.rows_to_frame(spark, [{"c": 1}], "a DOUBLE")


def test_partitioned_sink_prunes(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "case when id % 3 = 0 then 'test' else 'train' end AS split")
    for name, options in {"plain": {}, "few": {"max_files": 1}, "even": {"rebalance": True}}.items():
        path = str(tmp_path / name)
        sinks.write_partitioned(df, path, **options)
        sinks.write_partitioned(df, path, **options)  # overwrites
        back = readers.read_table(spark, path).filter("split = 'test'")
        assert back.count() == 34
        assert "PartitionFilters: [isnotnull(split" in plan_of(back)
    assert len(list((tmp_path / "few" / "split=train").glob("*.parquet"))) == 1


def test_report_roundtrip_and_absence(spark, tmp_path):
    path = str(tmp_path / "report")
    assert readers.read_report(spark, path) is None
    report = quality.nonfinite_counts(
        spark.createDataFrame([(1.0,), (float("nan"),)], "r double"), ["r"]
    ).unpivot([], ["r"], "key", "value").selectExpr("'bad' AS metric", "key", "value")
    sinks.write_report(report, path)
    assert [tuple(r) for r in readers.read_report(spark, path).collect()] == [("bad", "r", 1.0, None)]
    lines = [json.loads(x) for f in (tmp_path / "report").glob("*.json") for x in f.read_text().splitlines()]
    assert lines == [{"metric": "bad", "key": "r", "value": 1.0}]


def test_jdbc_options():
    """No database is started here; only what the writer is told is checked."""
    options = sinks.jdbc_options({"user": "u", "driver": "d"}, 4)
    assert options["truncate"] == "true" and options["stringtype"] == "unspecified"
    assert options["numPartitions"] == "4" and options["user"] == "u"


def test_jdbc_target():
    url, properties = sinks.jdbc_target({"PGHOST": "h", "PGUSER": "u", "PGPASSWORD": "p", "PGDATABASE": "d"})
    assert url == "jdbc:postgresql://h:5432/d" and properties["user"] == "u"
    with pytest.raises(KeyError):
        sinks.jdbc_target({})


def test_malformed_lines_reach_the_report(spark, tmp_path):
    good = csv_line(NSL_KDD, connection())
    (tmp_path / NSL_KDD.files["train"]).write_text("\n".join([good, "1,tcp", good]))
    (tmp_path / NSL_KDD.files["test"]).write_text(good + ",99\n")
    raw = readers.read_registry(spark, NSL_KDD, str(tmp_path), keep_corrupt=True)
    cleaned = clean.clean(raw, NSL_KDD)
    assert cleaned.count() == 3 and CORRUPT not in cleaned.columns
    path = str(tmp_path / "cleaned")
    cleaned.write.parquet(path)
    for stored in (None, spark.read.parquet(path)):
        report = long_report(quality.dq_stats(raw, NSL_KDD, cleaned=stored))
        assert report[("malformed_rows", "")] == 2 and report[("total_raw_rows", "")] == 4
        assert report[("final_cleaned_rows", "")] == 3 and report[("duplicates_removed", "")] == 1


def test_expected_rows(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",)], "source string")
    got = {r.source: (r.rows, r.status) for r in quality.expected_row_status(df, "source", {"a": 3, "b": 5}).collect()}
    assert got == {"a": (3, "ok"), "b": (2, "mismatch"), "c": (1, "unchecked")}
    assert NSL_KDD.expected_rows == {"train": 125_973, "test": 22_544}


def test_expected_rows_of_an_absent_source(spark):
    df = spark.createDataFrame([("train",)], "split string")
    got = {r.split: (r["rows"], r.status) for r in quality.expected_row_status(df, "split", {"train": 1, "test": 5}).collect()}
    assert got == {"train": (1, "ok"), "test": (0, "mismatch")}
    assert quality.expected_row_status(df, "split", {}).first().status == "unchecked"


def test_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    from types import SimpleNamespace

    from flowlake import session

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://somewhere:7077", setCheckpointDir=lambda folder: None)
    away = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(away)
    context.master = "local[2]"
    assert session.shared_folder(away)


def test_wide_rows_are_spread_over_tasks(spark, tmp_path):
    """However few splits a stored table has, a task gets a bounded number of rows;
    a small table is not shuffled, and no row is lost."""
    path = str(tmp_path / "compact")
    spark.range(10_000).coalesce(1).write.parquet(path)
    rows = readers.read_table(spark, path)
    spread = readers.spread_rows(rows, 1_000)
    sizes = spread.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) <= 1_100
    assert spread.distinct().count() == 10_000
    assert "Exchange" not in plan_of(readers.spread_rows(rows))


def test_partitions_are_written_side_by_side(spark, tmp_path):
    path = str(tmp_path / "split")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = spark.range(1_000).withColumn("split", F.when(F.col("id") % 3 == 0, "test").otherwise("train"))
    sinks.write_partitioned(rows.coalesce(1), path)
    stored = readers.read_table(spark, path)
    assert sorted(r.id for r in stored.filter("split = 'test'").collect()) == list(range(0, 1_000, 3))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_stored_json_takes_little_disk(spark, tmp_path):
    """Tables of wide rows are written far smaller than by default, and read back whole."""
    rows = spark.range(20_000).select(
        F.concat(F.lit("row-"), F.sha2(F.col("id").cast("string"), 256).substr(1, 16)).alias("name"),
        F.to_json(F.struct(*[(F.col("id") * n % 97 / 8).alias(f"number_{n}") for n in range(1, 30)])).alias("payload"),
        F.lit("train").alias("split")).coalesce(1)
    ours, default = tmp_path / "ours", tmp_path / "default"
    sinks.write_partitioned(rows, str(ours))
    rows.write.partitionBy("split").parquet(str(default))
    sizes = [sum(f.stat().st_size for f in folder.rglob("*.parquet")) for folder in (ours, default)]
    assert sizes[0] < 0.7 * sizes[1]
    back = readers.read_table(spark, str(ours)).select(*rows.columns)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()

"""Raw files to served tables, and the registered queries against DuckDB."""

import math

import duckdb
import pytest
from helpers import long_report
from pyspark.sql import functions as F

import __spark_entry__ as contract
from flowlake.operators import learn, serve
from flowlake.plans import bindings, catalog, workflow
from flowlake.sources import readers, sinks
from flowlake.specs import CICIDS2017, NSL_KDD

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark
    labels conversations""".split()


def write_raw(spark, sf_dir, folder):
    """The driver's tables as raw files in both physical layouts."""
    rows = bindings.raw_connections(spark, sf_dir)
    for split in ("train", "test"):
        rows.filter(F.col("split") == split).select(*NSL_KDD.columns).write.csv(f"{folder}/{NSL_KDD.files[split]}")
    rows = bindings.raw_flows(spark, sf_dir).withColumn("fwd_header_length_dup", F.col("fwd_header_length"))
    for day in bindings.DAYS:
        rows.filter(F.col("source_day") == day).select(*CICIDS2017.columns).write.option("header", True).csv(
            f"{folder}/{CICIDS2017.files[day]}"
        )


def test_whole_workflow(spark, sf_dir, tmp_path, monkeypatch):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    write_raw(spark, sf_dir, raw)
    specs = (NSL_KDD, CICIDS2017)
    layouts = [workflow.Layout(root, s.name) for s in specs]
    cleaned_rows = 0
    for spec, layout in zip(specs, layouts):
        workflow.clean_stage(spark, spec, raw, layout, null_as_nonfinite=True)
        workflow.feature_stage(spark, spec, layout)
        metrics = workflow.train_stage(spark, spec, layout, learn.TreeSettings(max_iter=2))
        report = {(r.metric, r.key): r.value for r in readers.read_report(spark, layout.quality_report).collect()}
        rows = readers.read_table(spark, layout.features).count()
        assert report[("final_cleaned_rows", "")] == rows
        assert report[("total_raw_rows", "")] > rows
        assert metrics["train_rows"] + metrics["test_rows"] == rows
        assert readers.read_report(spark, layout.metrics).filter("metric = 'auc_roc'").first().value == metrics["auc_roc"]
        cleaned_rows += rows
    assert metrics["split_strategy"].startswith("day-based")

    scored, stats = workflow.score_stage(
        spark, specs, layouts, f"{root}/scored", f"{root}/stats", "2024-01-01 00:00:00"
    )
    assert scored.count() == cleaned_rows == scored.select("flow_id").distinct().count()
    assert sum(r.total_flows for r in stats.collect()) == cleaned_rows
    assert stats.count() == 4
    some = scored.first().flow_id
    assert serve.lookup_by_id(scored, some).count() == 1
    page = serve.flows_page(scored, limit=10, dataset="nsl_kdd", predicted_label=1)
    assert page.items.count() == 10 and page.total.first().total > 10

    again, _ = workflow.score_stage(
        spark, specs, layouts, f"{root}/scored2", f"{root}/stats2", "2024-01-01 00:00:00"
    )
    assert again.select("flow_id").exceptAll(scored.select("flow_id")).count() == 0

    asked = [{"num_failed_logins": 4, "land": True}, {}, {"src_bytes": "many", "service": "ftp"}]
    answers = workflow.score_records(spark, "nsl_kdd", asked, layouts[0].model).orderBy("record").collect()
    assert [a.rule_flags for a in answers] == ["failed_logins,land_attack", "", None]
    assert answers[0].predicted_label in (0, 1) and answers[2].invalid_features == ["src_bytes"]
    for dataset, records in (("other", [{}]), ("nsl_kdd", [{"colour": 1}])):
        with pytest.raises(ValueError):
            workflow.score_records(spark, dataset, records, layouts[0].model)

    published = []
    monkeypatch.setattr(sinks, "write_jdbc", lambda df, url, table, properties, n=16: published.append((table, df.columns, n)))
    workflow.publish_stage(scored, stats, "jdbc:x", {})
    assert published[0][:2] == ("flows_scored", list(serve.COMMON_COLUMNS)) and published[1][0] == "dataset_stats"


def test_report_of_the_views(spark, sf_dir):
    from flowlake.operators import quality

    report = long_report(quality.dq_stats(bindings.raw_connections(spark, sf_dir), NSL_KDD))
    assert report[("duplicates_removed", "")] > 0
    assert ("novel_attack_types_in_test_not_in_train", "unlisted") in report


def test_entry(spark):
    assert contract.entry(spark).count() == 4


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value if value is None else str(value)


@pytest.mark.parametrize("name", sorted(catalog.all_oracles()))
def test_query_equals_its_twin(spark, sf_dir, duck, name):
    df = contract.queries()[name](spark, sf_dir)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    assert {c[0]: str(c[1]) for c in result.description} == {c: kinds[t] for c, t in df.dtypes}
    theirs = sorted([comparable(v) or "" for v in row] for row in result.fetchall())
    ours = sorted([comparable(v) or "" for v in row] for row in df.select(*[F.col(f"`{c}`") for c in columns]).collect())
    assert ours == theirs and ours


def test_every_query_without_a_twin_is_model_output():
    without = set(catalog.all_queries()) - set(catalog.all_oracles())
    assert without == {
        "ml_gbt_train", "ml_score", "ml_feature_importances", "top_importances", "ml_train_and_evaluate",
        "ml_train_conn", "ml_train_flow", "model_save", "model_load", "score_partial",
    }


def test_no_python_udf_in_any_plan(spark, sf_dir):
    from helpers import plan_of

    for name in ("clean_conn", "clean_flow", "union_datasets", "dataset_stats", "score_partial_features", "engineer_features"):
        plan = plan_of(contract.queries()[name](spark, sf_dir))
        assert "EvalPython" not in plan and "InPandas" not in plan

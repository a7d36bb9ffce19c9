"""Queries for sources and sinks: tables are written to the shared scratch
folder in the format under test and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.operators import clean, quality, serve
from flowlake.plans import bindings as b
from flowlake.plans.catalog import query
from flowlake.plans.queries_serve import stored
from flowlake.plans.twins import CONNECTION_KEY, nonfinite, names, twin
from flowlake.session import scratch_path
from flowlake.sources import readers, schema, sinks
from flowlake.specs import CICIDS2017, NSL_KDD

LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)
LINE_SCHEMA = schema.schema_from_columns(
    LINE_COLUMNS,
    strings=("l_returnflag", "l_linestatus"),
    ints=("l_linenumber",),
    longs=("l_orderkey", "l_partkey", "l_suppkey"),
)
LINE_SQL = f"SELECT {names(LINE_COLUMNS)}, 'train' AS split FROM lineitem"


def _line_csv(spark: SparkSession, sf_dir: str, header: list[str] | None = None) -> str:
    path = scratch_path(spark, "lineitem-csv")
    rows = b.table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    if header:
        rows = rows.toDF(*header)
    rows.write.option("header", header is not None).csv(path)
    return path


@query("src_csv_headerless", LINE_SQL)
def src_csv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_headerless_csv(spark, _line_csv(spark, sf_dir), LINE_SCHEMA, split="train")


@query("src_csv_positional", LINE_SQL.replace("AS split", "AS split, 'monday' AS source_day").replace('"l_tax", ', ""))
def src_csv_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = [f" field {i}" for i in range(len(LINE_COLUMNS))]
    return readers.read_positional_csv(
        spark, _line_csv(spark, sf_dir, wrong), LINE_SCHEMA,
        drop=("l_tax",), source_day="monday", split="train",
    )


@query("schema_from_columns", twin(f"SELECT {names(CONNECTION_KEY)}, difficulty FROM conn"))
def schema_from_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 43-column raw schema, applied to headerless files."""
    path = scratch_path(spark, "connections-csv")
    rows = b.connections(spark, sf_dir).select(*NSL_KDD.columns, "split")
    rows.write.partitionBy("split").csv(path)
    raw = schema.raw_schema(NSL_KDD)
    return readers.union_all([
        readers.read_headerless_csv(spark, f"{path}/split={s}", raw, split=s) for s in ("train", "test")
    ])


def _day_files(spark: SparkSession, sf_dir: str) -> str:
    """Raw flow files, one per day, in the 79-column physical layout."""
    folder = scratch_path(spark, "flow-days")
    rows = b.raw_flows(spark, sf_dir).withColumn("fwd_header_length_dup", F.col("fwd_header_length"))
    for day in b.DAYS:
        rows.filter(F.col("source_day") == day).select(*CICIDS2017.columns).write.option(
            "header", True
        ).csv(f"{folder}/{CICIDS2017.files[day]}")
    return folder


@query("src_registry_union", twin("""
    SELECT destination_port, flow_duration, flow_bytes_per_s, bwd_packets_per_s, label, source_day, split
    FROM flow"""))
def src_registry_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_registry(spark, CICIDS2017, _day_files(spark, sf_dir)).select(
        "destination_port", "flow_duration", "flow_bytes_per_s", "bwd_packets_per_s", "label",
        "source_day", "split",
    )


@query("src_parquet", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""")
def src_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = readers.read_table(spark, f"{sf_dir}/orders.parquet")
    return orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("sink_parquet_partitioned", twin(f"SELECT {names(CONNECTION_KEY)}, difficulty FROM conn"))
def sink_parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "connections")
    rows = b.connections(spark, sf_dir).select(*NSL_KDD.columns, "split")
    sinks.write_partitioned(rows, path, by=("split",))
    return readers.read_table(spark, path)


NONFINITE_REPORT_SQL = twin(" UNION ALL ".join(
    f"""SELECT 'nonfinite' AS metric, '{c}' AS "key",
        cast(sum(case when {nonfinite(c)} then 1 else 0 end) as double) AS value FROM flow"""
    for c in CICIDS2017.rate_columns
))


def _stored_report(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "report")
    counts = quality.nonfinite_counts(b.flows(spark, sf_dir), CICIDS2017.rate_columns)
    report = counts.unpivot([], list(CICIDS2017.rate_columns), "key", "value").withColumn(
        "metric", F.lit("nonfinite")
    )
    sinks.write_report(report, path)
    return path


@query("sink_report_json", NONFINITE_REPORT_SQL)
def sink_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("metric STRING, key STRING, value DOUBLE").json(_stored_report(spark, sf_dir))


@query("read_report", NONFINITE_REPORT_SQL)
def read_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_report(spark, _stored_report(spark, sf_dir)).drop("text")


@query("src_rows", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, cast(weight as double) AS weight, note FROM lineitem
    JOIN (VALUES ('R', 2.5, NULL), ('A', NULL, 'early'), ('N', 0.5, 'late')) w(flag, weight, note) ON l_returnflag = flag""")
def src_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request's records, with fields left out, met by a whole table."""
    records = [{"flag": "R", "weight": 2.5}, {"flag": "A", "note": "early"}, {"flag": "N", "weight": 0.5, "note": "late"}]
    request = readers.rows_to_frame(spark, records, "flag STRING, weight DOUBLE, note STRING")
    lines = b.table(spark, sf_dir, "lineitem").select(*b.CONNECTION_ID, "l_returnflag")
    return lines.join(request, lines.l_returnflag == request.flag).drop("flag")


@query("dq_expected_rows", """
    SELECT coalesce(l_returnflag, f) AS l_returnflag, coalesce(n, 0) AS "rows", cast(e as bigint) AS expected_rows,
        case when e is null then 'unchecked' when e = coalesce(n, 0) then 'ok' else 'mismatch' end AS status
    FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag)
    FULL JOIN (VALUES ('A', 20028), ('N', 1), ('absent', 5)) w(f, e) ON l_returnflag = f""")
def dq_expected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expected_row_status(
        b.table(spark, sf_dir, "lineitem"), "l_returnflag", {"A": 20028, "N": 1, "absent": 5}
    )


@query("tag_literal", "SELECT event_id, 'cicids2017' AS dataset_source, 'train' AS split FROM events")
def tag_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.tag(
        b.table(spark, sf_dir, "events").select("event_id"), dataset_source="cicids2017", split="train"
    )


@query("drop_dup_column", f"SELECT {names([c for c in LINE_COLUMNS if c != 'l_tax'])} FROM lineitem")
def drop_dup_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_columns(b.table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS), "l_tax")

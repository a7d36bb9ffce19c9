"""Flow-shaped views over the given tables.

`lineitem` rows are read as connection records and `events` rows as flow
records. Every view column is one expression valid in Spark SQL and in DuckDB;
`{k}` stands for the one JSON lookup the two spell differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.sources import readers
from flowlake.specs import CICIDS2017, NSL_KDD

ZERO = "cast(0 as double)"

CONNECTION_ID = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

CONNECTION_VIEW = {
    **{c: c for c in CONNECTION_ID},
    **{c: ZERO for c in NSL_KDD.numeric},
    "duration": "l_quantity",
    "protocol_type": "case when l_linestatus = 'O' then 'tcp' else 'udp' end",
    "service": "concat('svc', cast(l_partkey % 70 as string))",
    "flag": "l_returnflag",
    "src_bytes": "l_extendedprice",
    "dst_bytes": "l_extendedprice * l_tax + 0.0",
    "land": "case when l_tax = 0 then cast(1 as double) else cast(0 as double) end",
    "num_failed_logins": "cast(l_linenumber - 2 as double)",
    "logged_in": "cast(1 as double)",
    "root_shell": "case when l_returnflag = 'R' and l_discount >= 0.09 then cast(1 as double) else cast(0 as double) end",
    "num_root": "cast(l_suppkey % 5 - 3 as double)",
    "count": "l_quantity * 4",
    "srv_count": "cast(l_suppkey % 100 as double)",
    "serror_rate": "l_discount * 8 + 0.0",
    "rerror_rate": "l_tax * 7 + 0.0",
    "same_srv_rate": "1 - l_discount",
    "dst_host_count": "cast(l_suppkey as double)",
    # Learnable with noise; 'unlisted' is in no taxonomy and only in test.
    "attack_type": """
        case when (l_extendedprice > 60000) = (l_orderkey % 10 = 0) then 'normal'
             when l_shipdate >= timestamp '2000-01-01 00:00:00' and l_returnflag = 'R' then 'unlisted'
             when l_linenumber <= 3 then 'neptune'
             when l_linenumber <= 5 then 'satan'
             when l_linenumber = 6 then 'guess_passwd'
             else 'rootkit' end""",
    "difficulty": "l_linenumber",
    "split": "case when l_shipdate < timestamp '2000-01-01 00:00:00' then 'train' else 'test' end",
}

FLOW_VIEW = {
    "event_id": "event_id",
    **{c: ZERO for c in CICIDS2017.numeric},
    "destination_port": "case {k} % 10 when 0 then 4444 when 1 then 31337 when 2 then 443 else 80 end",
    "flow_duration": "cast(floor(value) as bigint) - 5",
    "total_fwd_packets": "cast({k} % 4 as double)",
    "total_backward_packets": "cast({k} % 3 as double)",
    "total_length_of_fwd_packets": "cast({k} % 2 as double) * 100",
    "total_length_of_bwd_packets": "cast({k} % 3 as double) * 100",
    "fwd_packet_length_mean": "cast({k} as double)",
    "flow_bytes_per_s": """
        case {k} % 20 when 0 then cast('Infinity' as double) when 1 then cast('NaN' as double)
                      when 2 then cast('-Infinity' as double) else cast({k} as double) end""",
    "flow_packets_per_s": "case when {k} % 25 = 0 then cast('Infinity' as double) else cast({k} % 7 as double) end",
    "fwd_packets_per_s": "case when {k} % 50 = 3 then cast('NaN' as double) else cast({k} % 5 as double) end",
    "bwd_packets_per_s": "nullif(cast({k} % 11 as double), 10)",
    "syn_flag_count": "cast({k} % 2 as double)",
    "ack_flag_count": "case when event_type = 'click' then cast(1 as double) else cast(0 as double) end",
    "label": """
        case event_type when 'error' then 'DDoS' when 'signup' then 'PortScan'
                        when 'purchase' then 'Oddity' else 'BENIGN' end""",
    "source_day": """
        case when extract(day from ts) <= 10 then 'monday'
             when extract(day from ts) <= 20 then 'wednesday' else 'friday_ddos' end""",
    "split": "case when extract(day from ts) <= 20 then 'train' else 'test' end",
    # A stand-in model: its score is a fixed function of the row.
    "attack_probability": "cast({k} as double) / 100",
    "prediction": "case when {k} >= 50 then cast(1 as double) else cast(0 as double) end",
    "user_id": "user_id",
}

SPARK_K = "cast(get_json_object(props, '$.k') as int)"
DUCK_K = "cast(json_extract_string(props, '$.k') as int)"

DAYS = ("monday", "wednesday", "friday_ddos")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spark_view(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e.replace('{k}', SPARK_K)} AS `{c}`" for c, e in columns.items()])


def _source(spark: SparkSession, sf_dir: str, name: str, spread: bool) -> DataFrame:
    rows = table(spark, sf_dir, name)
    return readers.spread_rows(rows) if spread else rows


def connections(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """`spread`: for tasks that gather the rows, which are thirty times as wide as
    stored."""
    return _spark_view(_source(spark, sf_dir, "lineitem", spread), CONNECTION_VIEW)


def flows(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return _spark_view(_source(spark, sf_dir, "events", spread), FLOW_VIEW)


def raw_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connection records as the raw files hold them, with a copy of every row
    (at a higher difficulty) whose flag is R."""
    rows = connections(spark, sf_dir, spread=True).select(*NSL_KDD.columns, "split")
    # Side by side, so that the table is read and spread once.
    twice = F.expr("case when flag = 'R' then array(difficulty, difficulty + 10) else array(difficulty) end")
    return rows.withColumn("difficulty", F.explode(twice))


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [c for c in CICIDS2017.columns if c not in CICIDS2017.dropped_columns]
    return flows(spark, sf_dir, spread=True).select(*columns, "source_day", "split")


def duck_view(columns: dict[str, str], source: str) -> str:
    chosen = ", ".join(f'{e.replace("{k}", DUCK_K)} AS "{c}"' for c, e in columns.items())
    return f"SELECT {chosen} FROM {source}"


def duck_connections() -> str:
    return duck_view(CONNECTION_VIEW, "lineitem")


def duck_flows() -> str:
    return duck_view(FLOW_VIEW, "events")

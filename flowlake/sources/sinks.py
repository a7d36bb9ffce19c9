"""Sinks: partitioned Parquet, JDBC reload, JSON reports, models."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from flowlake.sources import readers

# Files a task writes side by side before it sorts its rows by partition value.
OPEN_FILES = 8
# Rows with their JSON take less than half the disk they take with Spark's default.
COMPRESSION = "zstd"
_CONCURRENT_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("split",),
    max_files: int | None = None,
    rebalance: bool = False,
    lookup_column: str | None = None,
) -> None:
    """Overwrite a Parquet table partitioned by `by`.

    By default the frame is written as it is partitioned: a scan keeps its
    input splits, and after a shuffle AQE has already sized the partitions, so
    no extra shuffle is paid. `rebalance` lets AQE even out file sizes per
    partition value, for inputs of many small files. `max_files` is for small
    tables only: it narrows the writing stage to that many tasks.
    `lookup_column` prepares point and range lookups: every file is sorted by
    it (a local sort, no shuffle), so page statistics are tight, and carries a
    bloom filter on it. Without it nothing is sorted while a task meets no more than
    `OPEN_FILES` partition values.
    """
    if rebalance:
        df = df.hint("rebalance", *by)
    if max_files is not None:
        df = df.coalesce(max_files)
    if lookup_column is not None:
        df = df.sortWithinPartitions(*by, lookup_column)
    writer = df.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*by)
    if lookup_column is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{lookup_column}", "true")
    conf = df.sparkSession.conf
    before = conf.get(_CONCURRENT_WRITERS)
    conf.set(_CONCURRENT_WRITERS, str(OPEN_FILES if lookup_column is None else 0))
    try:
        writer.parquet(path)
    finally:
        conf.set(_CONCURRENT_WRITERS, before)


def jdbc_target(environment: Mapping[str, str] = os.environ) -> tuple[str, dict[str, str]]:
    """URL and properties of the serving database from the usual PostgreSQL
    client variables; nothing is hard-coded."""
    host, port = environment["PGHOST"], environment.get("PGPORT", "5432")
    properties = {
        "user": environment["PGUSER"],
        "password": environment["PGPASSWORD"],
        "driver": "org.postgresql.Driver",
    }
    return f"jdbc:postgresql://{host}:{port}/{environment['PGDATABASE']}", properties


def jdbc_options(properties: Mapping[str, str], connections: int) -> dict[str, str]:
    """`stringtype=unspecified` lets the database cast text into its JSON type;
    `truncate` keeps the table's own DDL on a full reload."""
    return {
        "stringtype": "unspecified",
        **properties,
        "truncate": "true",
        "numPartitions": str(connections),
    }


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], connections: int = 16
) -> None:
    """Full reload of a database table with at most `connections` writers. Feed
    it a stored table: a lower writer count also narrows what computes `df`."""
    writer = df.write.mode("overwrite").format("jdbc")
    writer.options(**jdbc_options(properties, connections)).option("url", url).option(
        "dbtable", table
    ).save()


def write_report(report: DataFrame, path: str) -> None:
    """A long report (`metric, key, value, text`) as JSON lines."""
    names = ("metric", "key", "value", "text")
    kinds = ("string", "string", "double", "string")
    present = [c for c in names if c in report.columns]
    report.select(
        *[report[c].cast(dict(zip(names, kinds))[c]).alias(c) for c in present]
    ).write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
    for key in [k for k in readers._MODELS if k[1] == path]:
        del readers._MODELS[key]

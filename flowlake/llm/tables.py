"""Reading the test tables, writing intermediate ones, registering queries."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from flowlake.session import scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_place(docs: DataFrame, fixed: Iterable[str] = ("doc_id", "text")) -> DataFrame:
    """docs with every column but the fixed ones named by its place, so that whatever
    they are called clashes with no name a stage uses. `toDF(*docs.columns)` gives
    them their names back."""
    return docs.toDF(*(c if c in fixed else f"__column_{i}" for i, c in enumerate(docs.columns)))


# For the side of a join that is no table of texts. It grows with the documents
# like the other side, so it is never broadcast, and texts needn't be sorted.
BUILD_SIDE = "shuffle_hash"

# Lets Spark drop a query's shuffle files as soon as the query has ended.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts the lineage
    and gives the planner its true size. What the query shuffled is not needed
    after that and is dropped."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)

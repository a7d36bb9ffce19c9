"""Queries for the learnt operators: toxicity and embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import embedding_dedup, toxicity
from flowlake.llm.tables import query, table


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda doc_id: ~held_out(doc_id))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
    )


@query("op9_embedding_dedup")
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.find_near_duplicates(table(spark, sf_dir, "embeddings"))

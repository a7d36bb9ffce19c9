"""Five stages that turn raw documents into encoded training documents.

Columns beside doc_id and text pass through all filtering stages under whatever name
they have; the last stage returns its own columns only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import decontaminate, jaccard_join, line_dedup, toxicity
from flowlake.llm.queries_models import held_out
from flowlake.llm.queries_text import piece_model
from flowlake.llm.sentencepiece_bpe import encode_decode
from flowlake.llm.tables import by_place, stored, table


# Texts on their way to and from Python workers, at a time. The stages' last steps are
# written by whoever runs them, so this is set for the session.
BATCH_BYTES = "8m"


def _bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go. The held-out labels are not learnt."""
    _bound_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda doc_id: ~held_out(doc_id))
    placed = by_place(docs)
    scored = toxicity.score(placed, model, keep=placed.columns)
    return scored.filter("score < 0.5").select(*placed.columns).toDF(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that stand earlier go; every document stays."""
    short = line_dedup.delete_repeated_lines(by_place(docs)).toDF(*docs.columns)
    return short.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else short


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id, a null id
    being the largest. Rows are documents of their own, whether or not they share
    an id: of repeated rows one stays, of two texts with one id each is judged for
    itself. Texts without words are in no group and all stay."""
    _bound_batches(spark)
    # Numbers stay the same only once they are written.
    placed = by_place(docs)
    rows = stored(placed.withColumn("__row", F.monotonically_increasing_id()), "numbered-documents")
    groups = jaccard_join.find_components(rows.select(F.col("__row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("__row"), "component_id")
    groups = stored(groups.join(rows.select("__row", "doc_id"), "__row"), "near-copy-groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).getField("__row").alias("__row")
    kept = groups.groupBy("component_id").agg(first).select("__row")
    gone = stored(groups.select("__row").join(kept, "__row", "left_anti"), "near-copies")
    return rows.join(gone, "__row", "left_anti").select(*placed.columns).toDF(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    _bound_batches(spark)
    placed = by_place(docs)
    found = decontaminate.find_contamination(placed, table(spark, sf_dir, "benchmark"), keep=placed.columns)
    return found.filter(F.size("hits") == 0).select(*placed.columns).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and a digest of the text they decode to."""
    _bound_batches(spark)
    coded = encode_decode(docs, piece_model())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

# Scores and encodings are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

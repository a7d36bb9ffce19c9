"""Every query against its SQL twin, and the pipeline stage by stage."""

import math
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowlake.llm import catalog, toxicity
from flowlake.llm.queries_models import held_out, op8_toxicity
from flowlake.llm.tables import stored

TABLES = ("documents", "embeddings", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.all_oracles()))
def test_query_equals_its_twin(spark, sf_dir, duck, name):
    df = catalog.all_queries()[name](spark, sf_dir)
    result = duck.execute(catalog.all_oracles()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    theirs = sorted(tuple(map(str, row)) for row in result.fetchall())
    assert sorted(tuple(map(str, row)) for row in df.select(*columns).collect()) == theirs and theirs


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in catalog.all_queries())
    assert numbers == list(range(1, 14))


def test_scores_use_neither_labels_nor_ids(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = op8_toxicity(spark, sf_dir).collect()
    assert len(rows) == docs.count() and all(r.predicted == int(r.score >= 0.5) and not math.isnan(r.score) for r in rows)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), lambda i: ~held_out(i))
    moved = docs.select((F.col("doc_id") + 10**6).alias("doc_id"), "text")
    again = {r.doc_id - 10**6: r.score for r in toxicity.score(moved, model).collect()}
    assert again == {r.doc_id: r.score for r in rows}


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, at = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        at[name] = (docs, docs := stored(stage(spark, docs, sf_dir), name))
        assert name == "sentencepiece" or docs.columns == columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = at["toxicity"]
    assert set(ids(after)) <= set(ids(before))
    before, after = at["line_dedup"]
    assert ids(before) == ids(after) and after.filter("n_chars <> length(text)").isEmpty()
    before, after = at["jaccard_join"]
    from test_llm_overlap import similar_components

    groups = similar_components([(r.doc_id, r.text) for r in before.collect()])
    assert ids(after) == sorted(i for i, _, own in groups if i == own)
    before, after = at["decontamination"]
    from test_llm_overlap import contamination

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert ids(after) == sorted(r.doc_id for r in before.collect() if not contamination(r.text, items)[1])
    before, after = at["sentencepiece"]
    assert ids(before) == ids(after) and after.filter("n_tokens <> size(ids)").isEmpty()
    whole = corpus_pipeline.run(spark, sf_dir).select("doc_id", "ids").collect()
    assert sorted(whole) == sorted(after.select("doc_id", "ids").collect())


def test_stages_with_clashing_column_names(spark, sf_dir):
    """Extra columns with names that operators use: each keeps its values."""
    names = ("score", "hits", "items", "key", "starts", "spans", "ids", "entities", "new_text", "kept", "passages", "__row", "lines", "node", "n")
    plain = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    docs = stored(plain.select("*", *(F.concat_ws("-", F.lit(c), "doc_id").alias(c) for c in names)), "clashing")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, sf_dir), name)
        assert after.columns == docs.columns and after.count() > 0
        assert after.filter(" OR ".join(f"`{c}` <> concat('{c}-', doc_id)" for c in names)).isEmpty()
    coded = corpus_pipeline.encode(spark, docs, sf_dir)
    assert coded.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and coded.count() == docs.count()


def test_near_copies_are_dropped_by_row(spark):
    one, other, third = (" ".join(f"{w}{i}" for i in range(40)) for w in "xyz")
    rows = [(5, one), (3, one), (3, other), (None, one), (7, third), (7, third), (None, "a b c d e f g"), (None, "a b c d e f g"),
            (8, ""), (8, ""), (None, None), (9, None), (4, other + " more")]
    docs = spark.createDataFrame([(i, t, "en", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, k int").repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(3, one), (3, other), (7, third), (None, "a b c d e f g"), (8, ""), (8, ""), (None, None), (9, None)], key=str)
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), "").count() == 0

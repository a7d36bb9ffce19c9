"""Queries for the learning operators. Transformations that SQL can restate
have a twin; anything that depends on a fitted model has none."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.operators import clean, learn, trees
from flowlake.operators.rules import engineer_features
from flowlake.plans import bindings as b
from flowlake.plans import workflow
from flowlake.plans.catalog import once_per_application, query
from flowlake.plans.queries_evaluate import predictions
from flowlake.plans.twins import CONNECTION_FLAGS_SQL, FLOW_KEY, flag_list, flag_names, names, twin
from flowlake.session import scratch_path
from flowlake.sources import readers, sinks
from flowlake.specs import CICIDS2017, NSL_KDD

RULE_COLUMNS = sorted(NSL_KDD.rules.flag_columns)


_SPECS = {NSL_KDD.name: NSL_KDD, CICIDS2017.name: CICIDS2017}


@once_per_application
def _feature_table(spark: SparkSession, sf_dir: str, dataset: str) -> str:
    """A dataset's feature table, stored first as the workflow does."""
    spec = _SPECS[dataset]
    raw = b.raw_connections(spark, sf_dir) if spec is NSL_KDD else b.raw_flows(spark, sf_dir)
    # The flow view has null rates; trees take none.
    features = engineer_features(clean.clean(raw, spec, null_as_nonfinite=True), spec.rules)
    path = scratch_path(spark, f"features-{dataset}")
    sinks.write_partitioned(features, path)
    return path


def _features(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return readers.read_table(spark, _feature_table(spark, sf_dir, dataset))


@once_per_application
def _trained(spark: SparkSession, sf_dir: str, dataset: str) -> learn.Trained:
    """One fit per tables and dataset, whatever queries ask for it."""
    return learn.fit_dataset(_features(spark, sf_dir, dataset), _SPECS[dataset])


@once_per_application
def _document(spark: SparkSession, sf_dir: str, dataset: str) -> dict:
    """The fit's metrics, for the queries that report them."""
    return learn.evaluate_dataset(_trained(spark, sf_dir, dataset), _features(spark, sf_dir, dataset), _SPECS[dataset])


def _model(spark: SparkSession, sf_dir: str, dataset: str = NSL_KDD.name) -> PipelineModel:
    return _trained(spark, sf_dir, dataset).model


def _metrics(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return learn.metrics_rows(spark, _document(spark, sf_dir, dataset))


@query("class_weight", twin("""
    SELECT event_id, is_attack, round(case when is_attack = 1
        then (SELECT cast(count(*) FILTER (is_attack = 0) as double) / count(*) FILTER (is_attack = 1) FROM pred)
        else 1 end, 6) AS class_weight FROM pred"""))
def class_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = learn.add_class_weight(predictions(spark, sf_dir))
    return weighted.select("event_id", "is_attack", F.round("class_weight", 6).alias("class_weight"))


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Flagged and indexed rows, and the names of all 46 model inputs."""
    rows = engineer_features(b.connections(spark, sf_dir), NSL_KDD.rules)
    indexed = learn.index_categories(rows, NSL_KDD.categorical).transform(rows)
    return indexed, learn.feature_columns(NSL_KDD.numeric, NSL_KDD.categorical, NSL_KDD.rules.flag_columns)


def _index_sql(column: str) -> str:
    return f"""(SELECT {column}, cast(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 as double)
        AS {column}_idx FROM conn GROUP BY {column}) {column}_index"""


_INDEXES = " ".join(f"JOIN {_index_sql(c)} ON conn.{c} = {c}_index.{c}" for c in NSL_KDD.categorical)
_INDEX_NAMES = ", ".join(f"{c}_idx" for c in NSL_KDD.categorical)
_INPUTS_SQL = (
    f"SELECT {names(b.CONNECTION_ID, 'conn.')}, {names(NSL_KDD.numeric, 'conn.')},"
    f" {flag_list(CONNECTION_FLAGS_SQL)}, {_INDEX_NAMES} FROM conn {_INDEXES}"
)


@query("feature_columns", twin(_INPUTS_SQL))
def feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All model inputs."""
    rows, inputs = _inputs(spark, sf_dir)
    return rows.select(*b.CONNECTION_ID, *inputs)


@query("ml_string_indexer", twin(f"""
    SELECT {names(b.CONNECTION_ID, 'conn.')}, {names(NSL_KDD.categorical, 'conn.')}, {_INDEX_NAMES} FROM conn {_INDEXES}"""))
def ml_string_indexer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.connections(spark, sf_dir).select(*b.CONNECTION_ID, *NSL_KDD.categorical)
    return learn.index_categories(rows, NSL_KDD.categorical).transform(rows)


@query("ml_assembler", twin(
    f"SELECT {names(b.CONNECTION_ID)}, {', '.join(f'cast({c} as double) AS {c}' for c in [*map(names, [[n] for n in NSL_KDD.numeric])])},"
    f" COLUMNS('rule_flag_.*')::DOUBLE, {_INDEX_NAMES} FROM ({_INPUTS_SQL})"))
def ml_assembler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector of all inputs, taken apart again."""
    rows, inputs = _inputs(spark, sf_dir)
    entries = vector_to_array(F.col("features"))
    vectors = learn.assembler(inputs).transform(rows)
    return vectors.select(*b.CONNECTION_ID, *[entries[i].alias(c) for i, c in enumerate(inputs)])


@query("ml_gbt_train")
def ml_gbt_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted trees, one row each: weight, nodes, depth."""
    trees = _model(spark, sf_dir).stages[-1]
    rows = [
        (i, float(w), t.numNodes, t.depth) for i, (t, w) in enumerate(zip(trees.trees, trees.treeWeights))
    ]
    return spark.createDataFrame(rows, "tree INT, weight DOUBLE, nodes INT, depth INT")


@query("ml_score")
def ml_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _features(spark, sf_dir, NSL_KDD.name)
    return learn.score_dataset(
        _model(spark, sf_dir), features, NSL_KDD, key=workflow.unique_key(NSL_KDD)
    )


@query("ml_score_columns", twin(f"""
    SELECT 'nsl_kdd' AS dataset_source, split, cast(null as varchar) AS source_day, protocol_type AS protocol, duration,
        src_bytes AS bytes_sent, dst_bytes AS bytes_received, is_attack AS is_attack_actual,
        attack_category AS attack_category_actual, {flag_names(CONNECTION_FLAGS_SQL)} AS rule_flags,
        true AS in_range, true AS is_threshold FROM clean_conn"""))
def ml_score_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the scored rows does not depend on the fitted trees."""
    score = F.col("attack_probability")
    return ml_score(spark, sf_dir).select(
        "dataset_source", "split", "source_day", "protocol", "duration", "bytes_sent", "bytes_received", "is_attack_actual",
        "attack_category_actual", "rule_flags", score.between(0, 1).alias("in_range"),
        ((F.col("predicted_label") == 1) == (score >= 0.5)).alias("is_threshold"))


@query("ml_score_ids", twin("SELECT count(*) AS scored, count(*) AS ids FROM clean_conn"))
def ml_score_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml_score(spark, sf_dir).agg(F.count("*").alias("scored"), F.count_distinct("flow_id").alias("ids"))


@query("model_roundtrip", twin(f"SELECT {names(NSL_KDD.columns)}, split, true AS same FROM clean_conn"))
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row scored by the fitted and by the stored model."""
    path = scratch_path(spark, "model")
    sinks.save_model(_model(spark, sf_dir), path)
    rows = _features(spark, sf_dir, NSL_KDD.name)
    fitted = learn.score(_model(spark, sf_dir), rows).select(*rows.columns, F.col("attack_probability").alias("fitted"))
    both = learn.score(readers.load_model(spark, path), fitted)
    return both.select(*NSL_KDD.columns, "split", (F.col("fitted") == F.col("attack_probability")).alias("same"))


@query("ml_train_counts", twin("""
    SELECT count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows,
        round(count(*) FILTER (split = 'train' AND is_attack = 1) / cast(count(*) FILTER (split = 'train') as double), 5) AS attack_rate_train,
        round(count(*) FILTER (split = 'test' AND is_attack = 1) / cast(count(*) FILTER (split = 'test') as double), 5) AS attack_rate_test,
        count(*) FILTER (split = 'test' AND attack_type NOT IN (SELECT attack_type FROM clean_conn WHERE split = 'train')) AS novel_total,
        count(*) FILTER (split = 'test') AS confusion_rows FROM clean_conn"""))
def ml_train_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics document's counts."""
    m = _document(spark, sf_dir, NSL_KDD.name)
    row = (*(m[k] for k in ("train_rows", "test_rows", "attack_rate_train", "attack_rate_test", "novel_total")), sum(m["confusion_matrix"].values()))
    return spark.createDataFrame([row], """train_rows long, test_rows long, attack_rate_train double,
        attack_rate_test double, novel_total long, confusion_rows long""")


@once_per_application
def _stored(spark: SparkSession, sf_dir: str, dataset: str) -> str:
    """Where a fitted model has been stored."""
    path = scratch_path(spark, f"model-{dataset}")
    sinks.save_model(_model(spark, sf_dir, dataset), path)
    return path


def _trees(spark: SparkSession, sf_dir: str, dataset: str = NSL_KDD.name) -> trees.StoredTrees:
    return trees.read_trees(spark, _stored(spark, sf_dir, dataset))


def _both_scores(spark: SparkSession, sf_dir: str, dataset: str, rows: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and whether the stored model and the expression compiled
    from its node table agree: same label, and the same score but for the order
    in which the trees are added up."""
    model = readers.load_model(spark, _stored(spark, sf_dir, dataset))
    by_model = learn.predict(model, rows).select(
        *rows.columns, F.col("attack_probability").alias("model_score"), F.col("prediction").alias("model_label"))
    both = trees.compile_trees(_trees(spark, sf_dir, dataset)).score(by_model)
    near = F.abs(F.col("attack_probability") - F.col("model_score")) <= 1e-12
    return both.select(*keep, (near & (F.col("prediction") == F.col("model_label"))).alias("same"))


@query("ml_score_compiled", twin(f"SELECT {names(NSL_KDD.columns)}, split, true AS same FROM clean_conn"))
def ml_score_compiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir, NSL_KDD.name)
    return _both_scores(spark, sf_dir, NSL_KDD.name, rows, [*NSL_KDD.columns, "split"])


@query("model_load_compiled", twin(f"""
    SELECT * REPLACE ({", ".join(f'coalesce("{c}", -1) AS "{c}"' for c in CICIDS2017.rate_columns)}), true AS same
    FROM (SELECT DISTINCT {names(c for c in FLOW_KEY if c not in CICIDS2017.rate_columns)},
        {", ".join(f'coalesce("{c}", -1) AS "{c}"' for c in CICIDS2017.rate_columns)} FROM valid_flow)"""))
def model_load_compiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir, CICIDS2017.name)
    return _both_scores(spark, sf_dir, CICIDS2017.name, rows, list(FLOW_KEY))


@query("score_partial_compiled", f"SELECT {names(b.CONNECTION_ID)}, true AS same FROM lineitem")
def score_partial_compiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = learn.complete_partial(_partial(spark, sf_dir), NSL_KDD, keep=b.CONNECTION_ID)
    return _both_scores(spark, sf_dir, NSL_KDD.name, rows, list(b.CONNECTION_ID))


_INPUT_NAMES = ", ".join(f"'{c}'" for c in learn.feature_columns(NSL_KDD.numeric, NSL_KDD.categorical, NSL_KDD.rules.flag_columns))


@query("ml_importances_by_nodes", f"SELECT unnest([{_INPUT_NAMES}]) AS feature, true AS same")
def ml_importances_by_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances added up from the stored nodes against the library's."""
    own = trees.importances(_trees(spark, sf_dir))
    theirs = learn.importances(_model(spark, sf_dir)).withColumnRenamed("importance", "library")
    near = F.abs(F.col("importance") - F.col("library")) <= 1e-5
    return own.join(theirs, "feature").select("feature", near.alias("same"))


@query("ml_tree_shapes", """
    SELECT i::INTEGER AS tree, case when i = 0 then 1.0::DOUBLE else 0.1::DOUBLE end AS weight, true AS within, true AS same
    FROM range(50) t(i)""")
def ml_tree_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tree's depth, and its nodes against those of the fitted one."""
    shapes = trees.shapes(_trees(spark, sf_dir))
    fitted = ml_gbt_train(spark, sf_dir).toDF("tree", "w", "n", "d")
    whole = (F.col("nodes") == F.col("n")) & (F.col("depth") == F.col("d")) & (F.col("nodes") == 2 * F.col("leaves") - 1)
    return shapes.join(fitted, "tree").select("tree", "weight", F.col("depth").between(1, 5).alias("within"), whole.alias("same"))


@query("ml_feature_importances")
def ml_feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.importances(_model(spark, sf_dir))


@query("top_importances")
def top_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.top_importances(_model(spark, sf_dir))


@query("ml_train_and_evaluate")
def ml_train_and_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model on the bare train and test tables, with all inputs."""
    features = _features(spark, sf_dir, NSL_KDD.name)
    _, metrics = learn.train_and_evaluate(
        clean.filter_split(features, "train"), clean.filter_split(features, "test"),
        NSL_KDD.numeric, NSL_KDD.categorical, flags=NSL_KDD.rules.flag_columns,
    )
    return learn.metrics_rows(spark, metrics)


@query("ml_train_conn")
def ml_train_conn(spark: SparkSession, sf_dir: str) -> DataFrame:
    novel = learn.novel_label_rows(_features(spark, sf_dir, NSL_KDD.name), NSL_KDD)
    return _metrics(spark, sf_dir, NSL_KDD.name).unionByName(novel)


@query("novel_label_rows", twin("""
    SELECT 'novel_attack_types_in_test' AS metric, cast(row_number() OVER (ORDER BY attack_type) - 1 AS varchar) AS "key",
        cast(null AS double) AS "value", attack_type AS "text"
    FROM (SELECT DISTINCT attack_type FROM clean_conn WHERE split = 'test'
        AND attack_type NOT IN (SELECT attack_type FROM clean_conn WHERE split = 'train'))"""))
def novel_label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.novel_label_rows(_features(spark, sf_dir, NSL_KDD.name), NSL_KDD)


@query("ml_train_flow")
def ml_train_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, CICIDS2017.name)


@query("model_save")
def model_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "model")
    sinks.save_model(_model(spark, sf_dir), path)
    return learn.importances(PipelineModel.load(path))


@query("model_load")
def model_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored model applied to the whole feature table."""
    path = scratch_path(spark, "model")
    sinks.save_model(_model(spark, sf_dir, CICIDS2017.name), path)
    features = _features(spark, sf_dir, CICIDS2017.name)
    return learn.score_dataset(
        readers.load_model(spark, path), features, CICIDS2017, key=workflow.unique_key(CICIDS2017)
    )


PARTIAL = {
    "duration": "nullif(l_quantity, 10)",
    # Text, and not always a number.
    "num_failed_logins": "case when l_linenumber = 7 then 'n/a' else cast(l_linenumber as string) end",
    "serror_rate": "case when l_linenumber = 6 then cast('NaN' as double) else l_discount * 8 + 0.0 end",
    "protocol_type": "nullif(l_returnflag, 'A')",
}


def _partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "lineitem").selectExpr(
        *b.CONNECTION_ID, *[f"{e} AS {c}" for c, e in PARTIAL.items()]
    )


PARTIAL_FLAGS = {
    **{n: CONNECTION_FLAGS_SQL[n] for n in ("failed_logins",)},
    "high_error_rate": "serror_rate >= 0.5",
}


@query("score_partial_features", f"""
    SELECT *, {flag_names(PARTIAL_FLAGS)} AS rule_flags FROM (
    SELECT {names(b.CONNECTION_ID)}, coalesce(nullif(l_quantity, 10), 0) AS duration,
        case when l_linenumber = 7 then cast(0 as double) else cast(l_linenumber as double) end AS num_failed_logins,
        case when l_linenumber = 6 then cast(0 as double) else l_discount * 8 + 0.0 end AS serror_rate,
        cast(1 as double) AS logged_in, cast(0 as double) AS src_bytes,
        coalesce(nullif(l_returnflag, 'A'), 'tcp') AS protocol_type, 'http' AS service, 'SF' AS flag,
        case l_linenumber when 7 then 'num_failed_logins' when 6 then 'serror_rate' else '' end AS invalid
    FROM lineitem)""")
def score_partial_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    completed = learn.complete_partial(_partial(spark, sf_dir), NSL_KDD, keep=b.CONNECTION_ID)
    return completed.select(
        *b.CONNECTION_ID, "duration", "num_failed_logins", "serror_rate", "logged_in", "src_bytes",
        "protocol_type", "service", "flag",
        F.array_join("invalid_features", ",").alias("invalid"), "rule_flags",
    )


@query("score_partial")
def score_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = learn.score_partial(
        _model(spark, sf_dir), _partial(spark, sf_dir), NSL_KDD, keep=b.CONNECTION_ID
    )
    return scored.withColumn("invalid_features", F.array_join("invalid_features", ","))

"""The common scored table and the queries served from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlake.functions import content_hash, json_payload, label_display, safe_ratio
from flowlake.specs import spec_for

# Columns of the served table, in order.
COMMON_COLUMNS = (
    "flow_id", "dataset_source", "split", "source_day", "protocol",
    "duration", "bytes_sent", "bytes_received", "is_attack_actual",
    "attack_category_actual", "predicted_label", "attack_probability",
    "rule_flags", "raw_features",
)
# Served columns that all scored tables have, by their name there.
SCORED_COLUMNS = {
    "split": "split", "is_attack_actual": "is_attack", "attack_category_actual": "attack_category",
    "predicted_label": "prediction", "attack_probability": "attack_probability",
    "rule_flags": "rule_flags", "raw_features": "raw_features",
}
COMMON_TYPES = {
    "source_day": "string", "protocol": "string", "duration": "double", "bytes_sent": "double",
    "bytes_received": "double", "predicted_label": "int",
}
MAX_PAGE = 2000

# A page that ends beyond this row is found by counting, not by a top-k that
# would hold offset + limit rows in every task and in the driver.
DEEP_PAGE_ROWS = 100_000
SLICE_HEX_DIGITS = 4


def flow_id(dataset: str, key: Sequence[str]) -> Column:
    """`<dataset>-<hash of the key columns>`: the same id after a repartition,
    a retry or a re-run. Unique if the key is."""
    return F.concat(F.lit(f"{dataset}-"), content_hash(key))


def number_copies(df: DataFrame, id_column: str, chunk: int = 100_000) -> DataFrame:
    """Makes `id_column` (a hash of the whole row) unique where whole rows
    repeat: copies get `.1`, `.2`, ... Identical rows are interchangeable, so
    they are counted, not ranked: a row that fills a third of the table is one
    group after partial aggregation. It is unfolded again in chunks that are
    spread over the cluster; rows with few copies unfold where they are.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    few = counted.filter(F.col("_n") <= chunk).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))
    )
    starts = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(chunk).cast("long"))
    many = (
        counted.filter(F.col("_n") > chunk)
        .withColumn("_from", F.explode(starts))
        .repartition(*[F.col(id_column), F.col("_from")])
        .withColumn(
            "_copy",
            F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + chunk, F.col("_n")) - 1)),
        )
        .drop("_from")
    )
    numbered = F.when(F.col("_copy") == 0, F.col(id_column)).otherwise(
        F.concat(F.col(id_column), F.lit("."), F.col("_copy").cast("string"))
    )
    unfolded = few.unionByName(many)
    return unfolded.select(*[numbered.alias(c) if c == id_column else F.col(c) for c in columns])


def _common_column(staged: DataFrame, dataset: str, name: str) -> Column:
    """A served column: the dataset's name, a column every scored table has, or
    the one the dataset's spec maps it to; null where the frame has none."""
    if name == "dataset_source":
        return F.lit(dataset).alias(name)
    own = SCORED_COLUMNS.get(name) or spec_for(dataset).common_columns.get(name)
    value = F.col(own) if own in staged.columns else F.lit(None)
    return (value.cast(COMMON_TYPES[name]) if name in COMMON_TYPES else value).alias(name)


def project_common_schema(
    scored: DataFrame, dataset: str, raw_columns: Sequence[str], key: Sequence[str] | None = None
) -> DataFrame:
    """A dataset's scored rows as the 14 common columns.

    `key` names columns that are unique together (a deduplicated table has
    them): ids then cost no shuffle. It may name `raw_features`, the JSON made
    here, for "all raw columns": their text is then produced once and hashed.
    Without a key the id is a hash of the whole projected row, and repeated
    rows are numbered.
    """
    staged = scored.withColumn("raw_features", json_payload(raw_columns))
    body = staged.select(
        *([flow_id(dataset, key).alias("flow_id")] if key else []),
        *[_common_column(staged, dataset, name) for name in COMMON_COLUMNS if name != "flow_id"],
    )
    if not key:
        rest = [c for c in COMMON_COLUMNS if c != "flow_id"]
        body = number_copies(body.withColumn("flow_id", flow_id(dataset, rest)), "flow_id")
    return body.select(*COMMON_COLUMNS)


def union_datasets(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def stamp(df: DataFrame, scored_at: str) -> DataFrame:
    """One `scored_at` literal for the whole run, so page order is stable."""
    return df.withColumn("scored_at", F.lit(scored_at).cast("timestamp"))


# --- filters -----------------------------------------------------------------


def flow_filter(
    dataset: str | None = None,
    split: str | None = None,
    predicted_label: int | None = None,
    attack_category: str | None = None,
) -> Column:
    """AND of the given equalities. An empty string counts as not given;
    `predicted_label` 0 is a filter."""
    conditions = []
    if dataset:
        conditions.append(F.col("dataset_source") == spec_for(dataset).name)
    if split:
        conditions.append(F.col("split") == split)
    if predicted_label is not None:
        if predicted_label not in (0, 1):
            raise ValueError("predicted_label must be 0 or 1")
        conditions.append(F.col("predicted_label") == predicted_label)
    if attack_category:
        conditions.append(F.col("attack_category_actual") == attack_category)
    return reduce(Column.__and__, conditions, F.lit(True))


def filter_flows(df: DataFrame, **filters) -> DataFrame:
    return df.filter(flow_filter(**filters))


def lookup_by_id(df: DataFrame, wanted: str) -> DataFrame:
    """At most one row. The dataset that an id begins with prunes partitions; on
    a table written for lookups by `flow_id` only the pages that may hold the id
    are read."""
    dataset = wanted.partition("-")[0]
    return df.filter((F.col("dataset_source") == dataset) & (F.col("flow_id") == wanted)).limit(1)


# --- pages ---------------------------------------------------------------------


@dataclass(frozen=True)
class Page:
    total: DataFrame  # one row, column `total`
    items: DataFrame
    limit: int
    offset: int


def _page_order() -> list[Column]:
    return [F.desc("scored_at"), F.asc("flow_id")]


def flows_page(df: DataFrame, limit: int = 50, offset: int = 0, **filters) -> Page:
    """Newest first, then by id. `df` needs `scored_at`.

    The page is found on its two order columns and only then fetched: a top-k
    of whole rows would move limit + offset JSON payloads out of every task.
    Finding it runs a job; at most `limit` keys come back.
    """
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    matching = filter_flows(df, **filters)
    if limit + offset <= DEEP_PAGE_ROWS:
        keys = shallow_page_keys(matching, limit, offset)
    else:
        keys = deep_page_keys(matching, limit, offset)
    return Page(
        matching.agg(F.count(F.lit(1)).alias("total")), fetch_page(matching, keys), limit, offset
    )


def shallow_page_keys(df: DataFrame, limit: int, offset: int) -> DataFrame:
    """Order columns of the rows offset..offset+limit by a top-k."""
    return df.select("scored_at", "flow_id").orderBy(*_page_order()).offset(offset).limit(limit)


def deep_page_keys(df: DataFrame, limit: int, offset: int) -> DataFrame:
    """The same keys without ordering the rows in front of them: count rows per
    (scored_at, dataset, leading hash digits), find the slices the page
    touches, order only those. Ids are `<dataset>-<hash>` and hashes are
    uniform, so slices are even and their order is the page order."""
    prefix = F.col("flow_id").substr(
        F.lit(1), F.length("dataset_source") + F.lit(1 + SLICE_HEX_DIGITS)
    )
    sliced = df.select("scored_at", "flow_id", prefix.alias("_slice"))
    counted = sliced.groupBy("scored_at", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each run that was scored, then the slices of a run by itself.
    runs = counted.groupBy("scored_at").agg(F.sum("_n").alias("_run"))
    newer = Window.orderBy(F.desc("scored_at")).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("scored_at").alias("_at"), F.coalesce(F.sum("_run").over(newer), F.lit(0)).alias("_before"), "_run")
    runs = runs.filter((F.col("_before") < offset + limit) & (F.col("_before") + F.col("_run") > offset))
    lower = Window.partitionBy("scored_at").orderBy(F.asc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.join(F.broadcast(runs), F.col("scored_at").eqNullSafe(F.col("_at"))).withColumn(
        "_start", F.col("_before") + F.coalesce(F.sum("_n").over(lower), F.lit(0)))
    touched = starts.filter(
        (F.col("_start") < offset + limit) & (F.col("_start") + F.col("_n") > offset)
    ).select("_at", F.col("_slice").alias("_part"), "_start")
    # A page touches at most limit + 2 slices: every one holds a row.
    inside = Window.partitionBy("scored_at", "_slice").orderBy(F.asc("flow_id"))
    same = F.col("scored_at").eqNullSafe(F.col("_at")) & F.col("_slice").eqNullSafe(F.col("_part"))
    return (
        sliced.join(F.broadcast(touched), same)
        .withColumn("_position", F.col("_start") + F.row_number().over(inside))
        .filter((F.col("_position") > offset) & (F.col("_position") <= offset + limit))
        .select("scored_at", "flow_id")
    )


def fetch_page(df: DataFrame, keys: DataFrame) -> DataFrame:
    """The keys' rows in page order. The keys' id range goes into the scan as
    literals: files sorted by id then skip all but a few of their pages."""
    found = keys.toArrow()
    if found.num_rows == 0:
        return df.filter(F.lit(False))
    if found.num_rows > MAX_PAGE:
        raise ValueError(f"a page has at most {MAX_PAGE} rows")
    ids = found.column("flow_id").to_pylist()
    known = [i for i in ids if i is not None]
    in_range = F.col("flow_id").between(min(known), max(known)) if known else F.lit(False)
    if len(known) < len(ids):
        in_range = in_range | F.col("flow_id").isNull()
    page = df.sparkSession.createDataFrame(found, keys.schema).toDF("_scored_at", "_flow_id")
    same = F.col("scored_at").eqNullSafe(F.col("_scored_at")) & F.col("flow_id").eqNullSafe(F.col("_flow_id"))
    return df.filter(in_range).join(F.broadcast(page), same, "left_semi").orderBy(*_page_order())


# --- statistics ------------------------------------------------------------------


def _totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_flows"),
        F.sum("is_attack_actual").alias("actual_attack_count"),
        F.sum("predicted_label").alias("predicted_attack_count"),
        F.avg("attack_probability").alias("avg_attack_probability"),
    ]


def dataset_stats(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("dataset_source", "split").agg(*_totals()).orderBy("dataset_source", "split")
    )


def summary_stats(df: DataFrame, dataset: str) -> DataFrame:
    """One row for a dataset; no row where it has no scored flows."""
    matching = df.filter(F.col("dataset_source") == spec_for(dataset).name)
    return matching.groupBy("dataset_source").agg(*_totals())


def predicted_attack_rate(summary: DataFrame) -> DataFrame:
    return summary.withColumn(
        "predicted_attack_rate",
        safe_ratio(F.col("predicted_attack_count"), F.col("total_flows")),
    )


def category_breakdown(df: DataFrame, dataset: str | None = None) -> DataFrame:
    """Flows and predicted attacks per actual category, most predicted first."""
    return (
        filter_flows(df, dataset=dataset)
        .groupBy(F.col("attack_category_actual").alias("attack_category"))
        .agg(
            F.count(F.lit(1)).alias("total_flows"),
            F.sum("predicted_label").alias("predicted_attack_count"),
        )
        .orderBy(F.desc("predicted_attack_count"), F.asc("attack_category"))
    )


def add_label_display(df: DataFrame, label: str = "predicted_label", output: str = "label_display") -> DataFrame:
    return df.withColumn(output, label_display(F.col(label)))

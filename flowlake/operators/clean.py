"""Cleaning: tagging, invalid rows, imputation, labels, deterministic dedup.

Dedup never gathers a key's copies in one task: each map task first folds its
own copies to one row (partial aggregation), so a key that makes up a third of
the table still sends one row per task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions import map_lookup, replace_nonfinite
from flowlake.specs import OTHER_CATEGORY, DatasetSpec


def tag(df: DataFrame, **tags: str) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in tags.items()})


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def drop_negative(df: DataFrame, column: str) -> DataFrame:
    """Keeps rows with column >= 0; a null goes too."""
    return df.filter(F.col(column) >= 0)


def filter_split(df: DataFrame, split: str) -> DataFrame:
    """One split; on a table partitioned by `split` only its files are read."""
    return df.filter(F.col("split") == split)


def filter_label(df: DataFrame, column: str, value: int) -> DataFrame:
    """Positives or negatives by the actual or the predicted label."""
    return df.filter(F.col(column) == value)


def impute_nonfinite(
    df: DataFrame, columns: Sequence[str], sentinel: float = -1.0, null_as_nonfinite: bool = False
) -> DataFrame:
    """NaN and ±Inf become the sentinel, in one projection. A null is kept
    unless `null_as_nonfinite` (tree training rejects nulls)."""
    def fixed(c: str) -> Column:
        value = replace_nonfinite(F.col(c), sentinel)
        return F.coalesce(value, F.lit(sentinel)) if null_as_nonfinite else value

    return df.withColumns({c: fixed(c) for c in columns})


def label_binary(label: Column, benign: str) -> Column:
    """0 for the benign label, 1 for anything else, null included."""
    return F.when(label == benign, F.lit(0)).otherwise(F.lit(1))


def label_category(label: Column, taxonomy: Mapping[str, str]) -> Column:
    return map_lookup(label, taxonomy, OTHER_CATEGORY)


def add_labels(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    label = F.col(spec.label)
    return df.withColumns({
        "is_attack": label_binary(label, spec.benign_label),
        "attack_category": label_category(label, spec.taxonomy),
    })


def dedup_smallest(df: DataFrame, keys: Sequence[str], carried: str) -> DataFrame:
    """One row per key with the smallest carried number. Key and buffer are
    both fixed-width friendly, so this plans as HashAggregate without a sort."""
    return df.groupBy(*keys).agg(F.min(carried).alias(carried)).select(*df.columns)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by `order`, then by the remaining columns,
    so the survivor does not depend on partitioning. An aggregate rather than
    a window: copies are folded before the shuffle."""
    rest = [c for c in order if c not in keys]
    rest += [c for c in df.columns if c not in keys and c not in rest]
    if not rest:
        return df.dropDuplicates()
    winner = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    return winner.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def duplicates_removed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows, distinct_rows and duplicates_removed for a key, from one scan."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("distinct_rows"),
        )
        .withColumn("duplicates_removed", F.col("rows") - F.col("distinct_rows"))
    )


def connection_keys(spec: DatasetSpec) -> list[str]:
    """Within-split key: every raw column but the carried ones, plus split."""
    skip = {*spec.carried_columns, *spec.dropped_columns}
    return [c for c in spec.columns if c not in skip] + ["split"]


def flow_keys(spec: DatasetSpec) -> list[str]:
    """Cross-source key: every raw column; neither source_day nor split."""
    skip = {*spec.carried_columns, *spec.dropped_columns}
    return [c for c in spec.columns if c not in skip]


def dedup_within_split(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Copies inside one split collapse; a row in both splits stays in both.
    Of each carried column (difficulty) the smallest value survives."""
    keys = connection_keys(spec)
    if not spec.carried_columns:
        return df.select(*keys).distinct().select(*[c for c in df.columns if c in keys])
    kept = df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in spec.carried_columns])
    return kept.select(*[c for c in df.columns if c in kept.columns])


def source_rank(spec: DatasetSpec, source: Column) -> Column:
    """Dedup precedence of a source as a small int. A source that the dataset
    does not declare stops the job instead of losing rows."""
    cases = F.when(F.lit(False), F.lit(0))
    for rank, key in enumerate(spec.source_order):
        cases = cases.when(source == key, F.lit(rank))
    problem = F.concat(F.lit("undeclared source: "), F.coalesce(source, F.lit("null")))
    return cases.otherwise(F.raise_error(problem).cast("int"))


def dedup_across_sources(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Copies across sources collapse to the first source by precedence (train
    before test). Only an int rank is carried through the aggregation; source
    and split are read off the winning rank afterwards."""
    keys = flow_keys(spec)
    ranked = df.withColumn("_rank", source_rank(spec, F.col("source_day")))
    winners = ranked.groupBy(*keys).agg(F.min("_rank").alias("_rank"))
    return _tag_winners(winners, spec).select(*df.columns)


def _tag_winners(winners: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Source and split of the winning `_rank`."""
    days = F.array(*[F.lit(k) for k in spec.source_order])
    splits = F.array(*[F.lit(spec.split_of(k)) for k in spec.source_order])
    position = F.col("_rank") + 1
    return winners.withColumns({
        "source_day": F.element_at(days, position),
        "split": F.element_at(splits, position),
    })


def clean_folded(folded: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The cleaned table from a (stored) fold of the raw rows (`quality.fold`)."""
    columns = [c for c in spec.columns if c not in spec.dropped_columns]
    if spec.day_files:
        kept = _tag_winners(drop_negative(folded, spec.duration_column), spec)
        return add_labels(kept.select(*columns, "split", "source_day"), spec)
    return add_labels(folded.select(*columns, "split"), spec)


def clean_connections(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    return add_labels(dedup_within_split(df, spec), spec)


def clean_flows(df: DataFrame, spec: DatasetSpec, null_as_nonfinite: bool = False) -> DataFrame:
    """Invalid durations out, rates imputed, then copies collapsed: the order
    matters, as rows that differ only in NaN against Inf are copies."""
    valid = drop_negative(df, spec.duration_column)
    imputed = impute_nonfinite(valid, spec.rate_columns, null_as_nonfinite=null_as_nonfinite)
    return add_labels(dedup_across_sources(imputed, spec), spec)


def clean(df: DataFrame, spec: DatasetSpec, null_as_nonfinite: bool = False) -> DataFrame:
    df = df.drop("_corrupt_record")  # a reader's note for the quality report
    if not spec.day_files:
        return clean_connections(df, spec)
    return clean_flows(df, spec, null_as_nonfinite)

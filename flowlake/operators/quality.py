"""Data-quality measures. A report is one scan of the raw rows, summed per
label; the few label rows are turned into long `metric, key, value` rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions import is_nonfinite
from flowlake.operators.clean import connection_keys, flow_keys, impute_nonfinite, source_rank
from flowlake.session import scratch_path
from flowlake.specs import DatasetSpec

# Where a reader keeps a malformed line (see sources.schema).
CORRUPT = "_corrupt_record"

# Up to this many values a computed list travels as a literal relation; a
# longer one stays a distributed side of the join.
LITERAL_ROWS = 10_000

# Bits for each value of a longer list, the most for all of them (16 MB), and what
# one bitmap of the built-in functions holds.
BITS_PER_VALUE = 16
BLOOM_BITS = 1 << 27
BITMAP_BITS = 32_768


def _count() -> Column:
    return F.count(F.lit(1))


def row_counts(df: DataFrame, source: str) -> DataFrame:
    return df.groupBy(source).agg(_count().alias("rows"))


def expected_row_status(df: DataFrame, source: str, expected: Mapping[str, int]) -> DataFrame:
    """Actual against expected rows per source. A mismatch is a status, never a
    failure; a source without an expectation passes, one that is expected and
    has no rows is reported with 0."""
    return expected_status(row_counts(df, source), source, expected)


def expected_status(counts: DataFrame, source: str, expected: Mapping[str, int]) -> DataFrame:
    """The same for rows that are counted already."""
    wanted = counts.sparkSession.createDataFrame(list(expected.items()), "expected_source string, expected_rows long")
    both = counts.join(wanted, F.col(source) == F.col("expected_source"), "full")
    whole = both.select(
        F.coalesce(source, "expected_source").alias(source), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "expected_rows"
    )
    return whole.withColumn(
        "status",
        F.when(F.col("expected_rows").isNull(), F.lit("unchecked"))
        .when(F.col("rows") == F.col("expected_rows"), F.lit("ok"))
        .otherwise(F.lit("mismatch")),
    )


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    return df.select(label).distinct()


def count_distinct_labels(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Distinct labels per split, null counted as a label. Two aggregations, so
    a hot label is folded before anything is counted."""
    return df.groupBy(split, label).agg(_count().alias("n")).groupBy(split).agg(
        _count().alias("distinct_labels")
    )


def novel_labels(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Labels of the test split that the train split lacks: one aggregation
    over one scan instead of a set difference of two, and null-safe."""
    seen = df.groupBy(label).agg(
        F.max(F.when(F.col(split) == "train", 1).otherwise(0)).alias("_train"),
        F.max(F.when(F.col(split) == "test", 1).otherwise(0)).alias("_test"),
    )
    return seen.filter("_test = 1 AND _train = 0").select(label)


def bounded(df: DataFrame, rows: int = LITERAL_ROWS) -> DataFrame:
    """The same rows, computed once: written to the shared folder, and from there
    a literal relation if there are at most `rows` of them. The planner then knows
    their exact size and broadcasts them if they fit its threshold; a longer list
    stays a stored table that a join shuffles, splitting skewed keys at run time."""
    path = scratch_path(df.sparkSession, "list")
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    head = stored.limit(rows + 1).toArrow()
    return stored if head.num_rows > rows else df.sparkSession.createDataFrame(head, df.schema)


def _is_literal(df: DataFrame) -> bool:
    return not df.inputFiles()


def may_occur(df: DataFrame, column: str, values: DataFrame, bits: int = BLOOM_BITS) -> DataFrame:
    """Rows whose value may occur in a long one-column list: all that do, and few
    others. The list is a Bloom filter of one hash, kept as bitmaps of 4 KB by
    leading part; it has `bits` bits at most whatever the length of the list, so
    broadcasting it is safe. Null may occur in a list with a null."""
    size = min(bits, max(BITMAP_BITS, 1 << (BITS_PER_VALUE * values.count()).bit_length()))

    def place(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(size))

    bitmaps = values.toDF("_value").select(place(F.col("_value")).alias("_place")).groupBy(
        (F.col("_place") / BITMAP_BITS).cast("long").alias("_bitmap")
    ).agg(F.bitmap_construct_agg(F.col("_place") % BITMAP_BITS).alias("_bits"))
    placed = df.withColumn("_place", place(F.col(column)))
    both = placed.join(F.broadcast(bitmaps), (F.col("_place") / BITMAP_BITS).cast("long") == F.col("_bitmap"))
    bit = (F.col("_place") % BITMAP_BITS).cast("int")
    byte = F.conv(F.hex(F.substr("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return both.filter(F.getbit(byte, bit % 8) == 1).select(*df.columns)


def rows_in_list(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose value occurs in a computed one-column list; null matches null.
    A list too long to be a literal is joined by shuffle, after most rows without
    a partner have been left out where they are read."""
    wanted = bounded(values).toDF("_wanted")
    # Values of two types are equal without having one hash.
    if not _is_literal(wanted) and df.schema[column].dataType == wanted.schema["_wanted"].dataType:
        df = may_occur(df, column, wanted)
    return df.join(wanted, F.col(column).eqNullSafe(F.col("_wanted")), "left_semi")


def novel_rows(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Test rows whose label does not occur in train."""
    return rows_in_list(df.filter(F.col(split) == "test"), label, novel_labels(df, label, split))


def is_unmapped(label: Column, taxonomy: Mapping[str, str]) -> Column:
    return F.coalesce(~label.isin(*taxonomy), F.lit(True))


def unmapped_labels(df: DataFrame, label: str, taxonomy: Mapping[str, str]) -> DataFrame:
    """Labels without a category. Filtered before the distinct, so mapped rows
    never reach the shuffle."""
    return df.select(label).filter(is_unmapped(F.col(label), taxonomy)).distinct()


def nonfinite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: NaN/±Inf cells of each column, and their total."""
    counted = df.agg(*[F.count_if(is_nonfinite(F.col(c))).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns), F.lit(0).cast("long"))
    return counted.withColumn("nonfinite_total", total)


def nonfinite_total(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return nonfinite_counts(df, columns).select("nonfinite_total")


Entry = tuple[str, "str | Column", Column]


def _long_rows(per_label: DataFrame, entries: Sequence[Entry]) -> DataFrame:
    """(metric, key, value) rows of every label row; null values are left out."""
    structs = [
        F.struct(
            F.lit(metric).alias("metric"),
            (F.lit(key) if isinstance(key, str) else key).alias("key"),
            value.cast("long").alias("value"),
        )
        for metric, key, value in entries
    ]
    return per_label.select(F.inline(F.array(*structs))).filter("value IS NOT NULL")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("metric", "key").agg(F.sum("value").alias("value"))


def _total(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(0))


def _counters(
    df: DataFrame, spec: DatasetSpec, sources: Sequence[str] | None, null_as_nonfinite: bool
) -> tuple[DataFrame, list[str]]:
    """The raw rows as cleaning sees them, with a 0/1 column for whatever a report
    counts row by row, and the names of those columns. Counted before the
    imputation hides what was there. Lines kept as malformed by the reader are
    counted where the frame has them."""
    counters: dict[str, Column] = {}
    if CORRUPT in df.columns:
        counters["_malformed"] = F.when(F.col(CORRUPT).isNotNull(), 1).otherwise(0)
    if spec.day_files:
        rank = source_rank(spec, F.col("source_day"))
        ranks = {key: position for position, key in enumerate(spec.source_order)}
        for c in spec.rate_columns:
            counters[f"_bad_{c}"] = F.when(is_nonfinite(F.col(c)), 1).otherwise(0)
            counters[f"_null_{c}"] = F.when(F.col(c).isNull(), 1).otherwise(0)
        for source in sources or spec.source_order:
            counters[f"_src_{source}"] = F.when(rank == ranks[source], 1).otherwise(0)
    counted = df.withColumns(counters)
    return impute_nonfinite(counted, spec.rate_columns, null_as_nonfinite=null_as_nonfinite), list(counters)


def fold(
    df: DataFrame, spec: DatasetSpec, sources: Sequence[str] | None = None, null_as_nonfinite: bool = False
) -> DataFrame:
    """Raw rows with their copies collapsed: the dedup key, what survives of the
    other columns (the smallest carried value; the winning source as `_rank`),
    `_n` rows and the sums of the counters. Stored once, it gives both the cleaned
    table (`clean.clean_folded`) and the quality report (`dq_stats_folded`), so raw
    files are read and parsed a single time.

    The counts are part of the aggregate, not metrics observed beside it: those
    are added up again when a lost executor's map tasks run a second time.
    """
    flagged, counters = _counters(df, spec, sources, null_as_nonfinite)
    if spec.day_files:
        keys, survivors = flow_keys(spec), {"_rank": source_rank(spec, F.col("source_day"))}
    else:
        keys, survivors = connection_keys(spec), {c: F.col(c) for c in spec.carried_columns}
    return flagged.groupBy(*keys).agg(
        *[F.min(c).alias(name) for name, c in survivors.items()],
        _count().alias("_n"), *[F.sum(c).alias(c) for c in counters],
    )


def _report(
    rows: DataFrame, cleaned: DataFrame | None, label: str, valid: Column, final: Column,
    measures: Mapping[str, Column], entries: Sequence[Entry],
) -> DataFrame:
    """Long report on rows of `_n` copies each with their counters, summed per
    label. `final` marks what each row adds to the final rows; with a stored
    cleaned table these are counted from there."""
    n = F.col("_n")
    if "_malformed" in rows.columns:
        measures = {**measures, "_malformed": F.sum("_malformed")}
        entries = [*entries, ("malformed_rows", "", F.col("_malformed"))]
    per_label = rows.groupBy(label).agg(
        F.sum(n).alias("_rows"),
        _total(valid, n).alias("_valid"),
        _total(valid, final).alias("_final"),
        *[value.alias(name) for name, value in measures.items()],
    )
    report = _long_rows(per_label, [
        *entries,
        ("total_raw_rows", "", F.col("_rows")),
        ("duplicates_removed", "", F.col("_valid") - F.col("_final")),
        ("final_cleaned_rows", "", F.col("_final")),
    ])
    if cleaned is not None:
        left = cleaned.groupBy(label).agg(_count().alias("_final"))
        report = report.unionByName(_long_rows(left, [
            ("duplicates_removed", "", -F.col("_final")),
            ("final_cleaned_rows", "", F.col("_final")),
        ]))
    # Every fixed line is there, with 0, even if there are no rows at all.
    fixed = {(m, k) for m, k, _ in entries if isinstance(k, str)} | {
        (m, "") for m in ("total_raw_rows", "duplicates_removed", "final_cleaned_rows")}
    zeros = _long_rows(rows.sparkSession.range(1), [(m, k, F.lit(0)) for m, k in sorted(fixed)])
    return _summed(report.unionByName(zeros))


def _rows_to_report(
    df: DataFrame, spec: DatasetSpec, sources: Sequence[str] | None, null_as_nonfinite: bool, cleaned: DataFrame | None
) -> tuple[DataFrame, Column]:
    """What `_report` sums up, and what a row adds to the final rows: the fold,
    whose rows are the final ones; or, next to a stored cleaned table, the raw
    rows where they are read, without the wide shuffle."""
    if cleaned is None:
        return fold(df, spec, sources, null_as_nonfinite), F.lit(1)
    flagged, _ = _counters(df, spec, sources, null_as_nonfinite)
    return flagged.withColumn("_n", F.lit(1)), F.lit(0)


def _connection_report(rows: DataFrame, final: Column, spec: DatasetSpec, cleaned: DataFrame | None) -> DataFrame:
    label, train, test = F.col(spec.label), F.col("_train"), F.col("_test")
    return _report(
        rows, cleaned, spec.label, F.lit(True), final,
        {f"_{s}": _total(F.col("split") == s, F.col("_n")) for s in ("train", "test")},
        [
            ("raw_row_counts", "train", train),
            ("raw_row_counts", "test", test),
            ("distinct_attack_types", "train", F.when(train > 0, 1).otherwise(0)),
            ("distinct_attack_types", "test", F.when(test > 0, 1).otherwise(0)),
            ("novel_attack_types_in_test_not_in_train", label, F.when((test > 0) & (train == 0), test)),
            ("attack_types_with_no_category_mapping", label,
             F.when(is_unmapped(label, spec.taxonomy), F.col("_rows"))),
        ],
    )


def _flow_report(
    rows: DataFrame, final: Column, spec: DatasetSpec, sources: Sequence[str], cleaned: DataFrame | None
) -> DataFrame:
    label, rates = F.col(spec.label), spec.rate_columns
    duration, n = F.col(spec.duration_column), F.col("_n")
    valid = duration >= 0
    cells = [f"_{kind}_{c}" for kind in ("bad", "null") for c in rates]
    return _report(
        rows, cleaned, spec.label, valid, final,
        {
            "_negative": _total(duration < 0, n),
            "_null": _total(duration.isNull(), n),
            **{name: _total(valid, F.col(name)) for name in cells},
            **{f"_src_{s}": F.sum(f"_src_{s}") for s in sources},
        },
        [
            *[("raw_row_counts_by_day", s, F.col(f"_src_{s}")) for s in sources],
            ("negative_duration_rows_dropped", "", F.col("_negative")),
            ("null_duration_rows_dropped", "", F.col("_null")),
            *[("rate_column_infinity_or_nan_imputed", c, F.col(f"_bad_{c}")) for c in rates],
            *[("rate_column_null", c, F.col(f"_null_{c}")) for c in rates],
            ("labels_with_no_category_mapping", label,
             F.when(is_unmapped(label, spec.taxonomy), F.col("_rows"))),
        ],
    )


def dq_stats_connections(
    df: DataFrame, spec: DatasetSpec, cleaned: DataFrame | None = None
) -> DataFrame:
    """Long report on raw connection rows: rows per split, duplicates, final
    rows, distinct labels per split, novel and unmapped labels (one row each,
    value = their rows). `cleaned` is the stored table made from these rows."""
    rows, final = _rows_to_report(df, spec, None, False, cleaned)
    return _connection_report(rows, final, spec, cleaned)


def dq_stats_flows(
    df: DataFrame,
    spec: DatasetSpec,
    sources: Sequence[str] | None = None,
    null_as_nonfinite: bool = False,
    cleaned: DataFrame | None = None,
) -> DataFrame:
    """Long report on raw flow rows: rows per source, negative and null
    durations, non-finite and null cells per rate column (counted on the rows
    that survive the duration filter), duplicates after imputation, final rows
    and unmapped labels. `null_as_nonfinite` must say what the cleaning it
    reports on does; `cleaned` is the stored table made from these rows.

    Every invalid-duration row forms groups of its own (the duration is part of
    the key), so one fold serves the counts before and after the filter.
    """
    sources = tuple(sources or spec.source_order)
    rows, final = _rows_to_report(df, spec, sources, null_as_nonfinite, cleaned)
    return _flow_report(rows, final, spec, sources, cleaned)


def dq_stats_folded(folded: DataFrame, spec: DatasetSpec, sources: Sequence[str] | None = None) -> DataFrame:
    """The same report from a (stored) fold, whatever imputation it was made with."""
    if not spec.day_files:
        return _connection_report(folded, F.lit(1), spec, None)
    return _flow_report(folded, F.lit(1), spec, tuple(sources or spec.source_order), None)


def dq_stats(
    df: DataFrame,
    spec: DatasetSpec,
    sources: Sequence[str] | None = None,
    null_as_nonfinite: bool = False,
    cleaned: DataFrame | None = None,
) -> DataFrame:
    if not spec.day_files:
        return dq_stats_connections(df, spec, cleaned)
    return dq_stats_flows(df, spec, sources, null_as_nonfinite, cleaned)

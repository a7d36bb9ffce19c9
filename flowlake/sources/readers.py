"""Sources: CSV (headerless or with an unusable header), Parquet, records,
reports and saved models."""

from __future__ import annotations

import math
import os
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.sources.schema import CORRUPT, raw_schema, with_corrupt_column
from flowlake.specs import DatasetSpec

# Rows a task takes where they are made wide: at one to two kilobytes each, a sort or a
# hash table of so many stays in a task's memory.
WIDE_ROWS = 150_000

REPORT_SCHEMA = "metric STRING, key STRING, value DOUBLE, text STRING"

_MODELS: dict[tuple[str, str], PipelineModel] = {}


def _keeping_corrupt(reader: DataFrameReader) -> DataFrameReader:
    """A pruned read looks at no more tokens than it needs and so misses
    malformed lines: pruning is off where they are asked for."""
    return reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)


def read_headerless_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, keep_corrupt: bool = False, **tags: str
) -> DataFrame:
    """Headerless CSV under an explicit schema, tagged with constant columns.
    `keep_corrupt` adds `_corrupt_record`, set on lines that are too short,
    too long or hold an unreadable value."""
    reader = spark.read
    if keep_corrupt:
        schema = with_corrupt_column(schema)
        reader = _keeping_corrupt(reader)
    return reader.schema(schema).csv(path).withColumns({k: F.lit(v) for k, v in tags.items()})


def read_positional_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    drop: Sequence[str] = (),
    keep_corrupt: bool = False,
    **tags: str,
) -> DataFrame:
    """CSV whose header line is wrong: the line is skipped and columns are
    bound by position. Duplicated physical columns can be dropped."""
    reader = spark.read.option("header", True).option("enforceSchema", True)
    if keep_corrupt:
        schema = with_corrupt_column(schema)
        reader = _keeping_corrupt(reader)
    df = reader.schema(schema).csv(path).drop(*drop)
    return df.withColumns({k: F.lit(v) for k, v in tags.items()})


def source_file(spec: DatasetSpec, folder: str, source: str) -> str:
    """Path of a source's raw file; a source the dataset lacks is an error."""
    try:
        return os.path.join(folder, spec.files[source])
    except KeyError:
        raise ValueError(f"{spec.name} has no source {source!r}, only {', '.join(spec.files)}") from None


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Fold of `unionByName`; Catalyst flattens it into one Union."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(DataFrame.unionByName, frames)


def _source_name(names: Sequence[str]) -> Column:
    """Name of the registered file a row comes from: the file itself, or else the
    folder it is a part of. Paths are percent-encoded there, except for `+`."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    return F.when(last.isin(*names), last).otherwise(F.element_at(parts, -2))


def read_registry(
    spark: SparkSession,
    spec: DatasetSpec,
    folder: str,
    keys: Sequence[str] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """A dataset's raw sources, each row tagged with its split (train if listed
    as a train source, else test) and, for day files, `source_day`.

    All files are one scan, however many there are: the tags come from a table
    of sources, joined by the name of the file a row was read from. A row of no
    registered file stops the job instead of losing its tags."""
    schema = raw_schema(spec)
    paths = {key: source_file(spec, folder, key) for key in keys or spec.default_sources}
    names = [os.path.basename(path) for path in paths.values()]
    if len(set(names)) < len(names):
        raise ValueError(f"{spec.name} has sources that share a file: {sorted(names)}")
    reader = _keeping_corrupt(spark.read) if keep_corrupt else spark.read
    if spec.header_line:
        reader = reader.option("header", True).option("enforceSchema", True)
    rows = reader.schema(with_corrupt_column(schema) if keep_corrupt else schema).csv(list(paths.values()))
    # One row for each source.
    tags = [(name, key, spec.split_of(key)) for key, name in zip(paths, names)]
    sources = spark.createDataFrame(tags, "_name string, _source string, _split string")
    tagged = rows.withColumn("_file", _source_name(names)).join(F.broadcast(sources), F.col("_file") == F.col("_name"), "left")
    unknown = F.raise_error(F.concat(F.lit("rows of an unregistered file: "), "_file")).cast("string")
    tagged = tagged.withColumn("split", F.coalesce("_split", unknown))
    if spec.day_files:
        tagged = tagged.withColumn("source_day", F.col("_source"))
    return tagged.drop("_file", "_name", "_source", "_split", *spec.dropped_columns)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread_rows(df: DataFrame, rows: int = WIDE_ROWS) -> DataFrame:
    """A stored table, dealt to tasks of so many rows. For tables of compact rows that
    are made wide (JSON, dozens of numbers) and then sorted or folded: a scan split
    holds so many of them that a task would have to spill what it makes of them, and
    more so the larger the table. They are shuffled while they are narrow; a table
    for a single task is left as it is."""
    tasks = math.ceil(df.count() / rows)
    return df.repartition(tasks) if tasks > 1 else df


def rows_to_frame(spark: SparkSession, rows: Sequence[Mapping], schema: T.StructType | str) -> DataFrame:
    """In-memory records (a request's worth) as a DataFrame. Fields a record
    lacks are null; a field outside the schema is an error."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    for row in rows:
        extra = set(row) - set(names)
        if extra:
            raise ValueError(f"Unknown field(s): {sorted(extra)}")
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def read_report(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored report, or None where none has been written yet."""
    try:
        return spark.read.schema(REPORT_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_model(spark: SparkSession, path: str, keep: bool = False) -> PipelineModel:
    """A fitted pipeline. With `keep` it is read once per application and path:
    right for many small requests, not for a batch after a retrain."""
    if not keep:
        return PipelineModel.load(path)
    key = (spark.sparkContext.applicationId, path)
    if key not in _MODELS:
        _MODELS[key] = PipelineModel.load(path)
    return _MODELS[key]

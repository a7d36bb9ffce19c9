"""Explicit schemas from ordered column names; nothing is ever inferred."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import types as T

from flowlake.operators.quality import CORRUPT
from flowlake.specs import DatasetSpec


def schema_from_columns(
    columns: Sequence[str],
    strings: Collection[str] = (),
    ints: Collection[str] = (),
    longs: Collection[str] = (),
) -> T.StructType:
    """Double unless a column is listed as string, int or long."""
    def type_of(name: str) -> T.DataType:
        if name in strings:
            return T.StringType()
        if name in ints:
            return T.IntegerType()
        if name in longs:
            return T.LongType()
        return T.DoubleType()

    return T.StructType([T.StructField(c, type_of(c)) for c in columns])


def raw_schema(spec: DatasetSpec) -> T.StructType:
    return schema_from_columns(
        spec.columns, spec.string_columns, spec.int_columns, spec.long_columns
    )


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """The schema plus the column in which Spark keeps a malformed line."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])

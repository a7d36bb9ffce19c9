"""Built-in-only column expressions: everything here stays in codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

PROBABILITY_DIGITS = 5
HASH_HEX_DIGITS = 32


def is_nonfinite(value: Column) -> Column:
    """True for NaN and both infinities; null for null."""
    return F.isnan(value) | (F.abs(value) == F.lit(float("inf")))


def replace_nonfinite(value: Column, sentinel: float = -1.0) -> Column:
    """Sentinel for NaN/±Inf, the value otherwise. A null stays null."""
    return F.when(is_nonfinite(value), F.lit(sentinel)).otherwise(value)


def map_lookup(key: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Value of a small literal mapping; `default` for unknown and null keys."""
    if not mapping:
        return F.lit(default)
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(pairs[key], F.lit(default))


def safe_ratio(
    numerator: Column, denominator: Column, digits: int | None = None, empty: float | None = 0.0
) -> Column:
    """numerator/denominator, `empty` on a zero or null denominator."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    if digits is not None:
        ratio = F.round(ratio, digits)
    return ratio if empty is None else F.coalesce(ratio, F.lit(float(empty)))


def snap(value: Column, step: float) -> Column:
    """Nearest multiple of `step` (half up)."""
    return F.round(value / F.lit(step)) * F.lit(step)


def round_probability(value: Column) -> Column:
    return F.round(value, PROBABILITY_DIGITS)


def positive_probability(vector: Column) -> Column:
    """Second entry of a two-class probability vector."""
    return vector_to_array(vector)[1]


def label_display(label: Column) -> Column:
    return F.when(label == 1, F.lit("Attack")).when(label == 0, F.lit("Benign"))


def join_flag_names(flags: Mapping[str, Column]) -> Column:
    """Names whose 0/1 column is 1, comma-joined in mapping order; '' if none."""
    return F.concat_ws(",", *[F.when(flag == 1, F.lit(name)) for name, flag in flags.items()])


def json_payload(columns: Iterable[str]) -> Column:
    """The columns as one JSON object; null fields are left out."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]))


def content_hash(columns: Iterable[str]) -> Column:
    """Hex digest of the columns' text. Every value is written with its length
    in front and null has its own mark, so distinct rows never encode alike."""
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.substring(F.sha2(F.concat(*parts), 256), 1, HASH_HEX_DIGITS)

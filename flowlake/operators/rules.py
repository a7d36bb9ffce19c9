"""Declarative rule flags: a name and a SQL predicate each."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions import join_flag_names

FLAG_PREFIX = "rule_flag_"


@dataclass(frozen=True)
class RuleSet:
    """Named predicates in declaration order. A predicate that is false or
    null (a null input) gives 0."""

    predicates: Mapping[str, str] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return list(self.predicates)

    @property
    def flag_columns(self) -> list[str]:
        return [FLAG_PREFIX + name for name in self.predicates]

    def flag(self, name: str) -> Column:
        return F.when(F.expr(self.predicates[name]), F.lit(1)).otherwise(F.lit(0))

    def add_flag(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(FLAG_PREFIX + name, self.flag(name))

    def add_flags(self, df: DataFrame) -> DataFrame:
        return df.withColumns({FLAG_PREFIX + name: self.flag(name) for name in self.predicates})

    def add_joined_names(self, df: DataFrame, output: str = "rule_flags") -> DataFrame:
        """`rule_flags`: names of the flags that are 1, in declaration order."""
        flags = {name: F.col(FLAG_PREFIX + name) for name in self.predicates}
        return df.withColumn(output, join_flag_names(flags) if flags else F.lit(""))


def engineer_features(df: DataFrame, rules: RuleSet) -> DataFrame:
    """All flags of a rule set plus the joined names. Row-wise: one Project,
    valid on batch and streaming frames alike."""
    return rules.add_joined_names(rules.add_flags(df))

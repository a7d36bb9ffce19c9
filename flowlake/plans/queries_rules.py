"""Queries for the rule flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions import join_flag_names
from flowlake.operators.rules import FLAG_PREFIX, engineer_features
from flowlake.plans import bindings as b
from flowlake.plans.catalog import query
from flowlake.plans.twins import CONNECTION_FLAGS_SQL, FLOW_FLAGS_SQL, flag, flag_list, flag_names, names, twin
from flowlake.specs import CICIDS2017, CONNECTION_RULES, FLOW_RULES, NSL_KDD


def _register_connection_rule(name: str, condition: str) -> None:
    @query(f"rule_{name}", twin(f"SELECT {names(b.CONNECTION_ID)}, {flag(condition)} AS rule_flag_{name} FROM conn"))
    def single(spark: SparkSession, sf_dir: str) -> DataFrame:
        flagged = CONNECTION_RULES.add_flag(b.connections(spark, sf_dir), name)
        return flagged.select(*b.CONNECTION_ID, FLAG_PREFIX + name)


def _register_flow_rule(name: str, condition: str) -> None:
    @query(f"rule_{name}", twin(f"SELECT event_id, {flag(condition)} AS rule_flag_{name} FROM flow"))
    def single(spark: SparkSession, sf_dir: str) -> DataFrame:
        return FLOW_RULES.add_flag(b.flows(spark, sf_dir), name).select("event_id", FLAG_PREFIX + name)


for _name, _condition in CONNECTION_FLAGS_SQL.items():
    _register_connection_rule(_name, _condition)
for _name, _condition in FLOW_FLAGS_SQL.items():
    _register_flow_rule(_name, _condition)


@query("rule_flags_join", twin(f"SELECT event_id, {flag_names(FLOW_FLAGS_SQL)} AS rule_flags FROM flow"))
def rule_flags_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = FLOW_RULES.add_flags(b.flows(spark, sf_dir))
    return FLOW_RULES.add_joined_names(flagged).select("event_id", "rule_flags")


@query("engineer_features", twin(f"""
    SELECT {names(b.CONNECTION_ID)}, {flag_list(CONNECTION_FLAGS_SQL)},
        {flag_names(CONNECTION_FLAGS_SQL)} AS rule_flags FROM conn"""))
def engineer_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = engineer_features(b.connections(spark, sf_dir), NSL_KDD.rules)
    return features.select(*b.CONNECTION_ID, *NSL_KDD.rules.flag_columns, "rule_flags")


@query("engineer_features_flow", twin(f"""
    SELECT event_id, {flag_list(FLOW_FLAGS_SQL)}, {flag_names(FLOW_FLAGS_SQL)} AS rule_flags FROM flow"""))
def engineer_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = engineer_features(b.flows(spark, sf_dir), CICIDS2017.rules)
    return features.select("event_id", *CICIDS2017.rules.flag_columns, "rule_flags")


@query("fn_array_filter_join", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        concat_ws(',', case when l_quantity >= 45 then 'bulk' end, case when l_discount = 0 then 'full_price' end,
            case when l_returnflag = 'R' and l_linestatus = 'O' then 'open_return' end) AS marks
    FROM lineitem""")
def fn_array_filter_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = join_flag_names({
        "bulk": F.expr("int(l_quantity >= 45)"),
        "full_price": F.expr("int(l_discount = 0)"),
        "open_return": F.expr("int(l_returnflag = 'R' AND l_linestatus = 'O')"),
    })
    return b.table(spark, sf_dir, "lineitem").select(*b.CONNECTION_ID, marks.alias("marks"))

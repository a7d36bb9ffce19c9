import pytest

from flowlake.operators.rules import RuleSet, engineer_features
from flowlake.specs import CONNECTION_RULES, FLOW_RULES

CONNECTION_INPUTS = ["num_failed_logins", "land", "root_shell", "num_root", "count", "serror_rate", "rerror_rate"]
FLOW_INPUTS = {
    "total_length_of_fwd_packets": 10.0, "total_length_of_bwd_packets": 10.0, "syn_flag_count": 0.0,
    "ack_flag_count": 1.0, "total_backward_packets": 1.0, "destination_port": 80,
}


def connection_flags(spark, **values):
    row = {**{c: 0.0 for c in CONNECTION_INPUTS}, **values}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"`{c}` double" for c in row))
    return engineer_features(df, CONNECTION_RULES).first()


def flow_flags(spark, **values):
    row = {**FLOW_INPUTS, **values}
    kinds = {c: "int" if c == "destination_port" else "double" for c in row}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} {kinds[c]}" for c in row))
    return engineer_features(df, FLOW_RULES).first()


@pytest.mark.parametrize("values, expected", [
    ({}, ""),
    ({"num_failed_logins": 2.0}, ""), ({"num_failed_logins": 3.0}, "failed_logins"),
    ({"land": 1.0}, "land_attack"), ({"land": 2.0}, ""),
    ({"root_shell": 1.0}, "root_privilege"), ({"num_root": 1.0}, "root_privilege"),
    ({"count": 99.0}, ""), ({"count": 100.0}, "high_connection_rate"),
    ({"serror_rate": 0.49}, ""), ({"serror_rate": 0.5}, "high_error_rate"), ({"rerror_rate": 0.5}, "high_error_rate"),
    ({"serror_rate": 0.9, "count": 500.0, "num_failed_logins": 5.0}, "failed_logins,high_connection_rate,high_error_rate"),
    ({c: None for c in CONNECTION_INPUTS}, ""),
    ({"root_shell": None, "num_root": 2.0}, "root_privilege"),
])
def test_connection_rules(spark, values, expected):
    row = connection_flags(spark, **values)
    assert row.rule_flags == expected
    assert [n for n in CONNECTION_RULES.names if row["rule_flag_" + n] == 1] == [x for x in expected.split(",") if x]


@pytest.mark.parametrize("values, expected", [
    ({}, ""),
    ({"total_length_of_fwd_packets": 0.0}, ""),
    ({"total_length_of_fwd_packets": 0.0, "total_length_of_bwd_packets": 0.0}, "zero_payload"),
    ({"syn_flag_count": 1.0}, ""), ({"syn_flag_count": 1.0, "ack_flag_count": 0.0}, "syn_flood_like"),
    *[({"destination_port": p}, "malicious_port") for p in (4444, 31337, 1337, 6667)],
    ({"total_backward_packets": 0.0}, "asymmetric_flow"),
    ({"total_backward_packets": 0.0, "destination_port": 4444}, "malicious_port,asymmetric_flow"),
    ({c: None for c in FLOW_INPUTS}, ""),
])
def test_flow_rules(spark, values, expected):
    row = flow_flags(spark, **values)
    assert row.rule_flags == expected
    assert all(row[c] in (0, 1) for c in FLOW_RULES.flag_columns)


def test_empty_rule_set(spark):
    assert engineer_features(spark.range(1), RuleSet()).first().rule_flags == ""


def test_features_follow_a_stream(spark, tmp_path):
    """The same row-wise functions on a file stream give the batch result."""
    from helpers import flow, flows

    from flowlake.operators.clean import add_labels, drop_negative, impute_nonfinite
    from flowlake.specs import CICIDS2017
    from flowlake.streaming import features as streaming

    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    rows = [flow("monday", flow_duration=i - 1, destination_port=p) for i, p in enumerate([80, 4444, 6667])]
    batch = flows(spark, rows)
    batch.write.parquet(source)
    stream = streaming.follow_table(spark, source, batch.schema)
    streaming.append_features(stream, CICIDS2017, out, checkpoint).awaitTermination(60)
    expected = engineer_features(
        add_labels(impute_nonfinite(drop_negative(batch, "flow_duration"), CICIDS2017.rate_columns), CICIDS2017),
        FLOW_RULES,
    )
    wanted = ["flow_duration", "rule_flags", "is_attack"]
    got = spark.read.parquet(out)
    assert sorted(map(tuple, got.select(wanted).collect())) == sorted(map(tuple, expected.select(wanted).collect()))
    assert got.count() == 2

"""Shared SQL for the DuckDB twins: the flow-shaped views and what follows from
them, each as a named WITH clause."""

from __future__ import annotations

import re

from flowlake.plans.bindings import CONNECTION_ID, duck_connections, duck_flows
from flowlake.specs import CICIDS2017, NSL_KDD

CONNECTION_RAW = [c for c in NSL_KDD.columns] + ["split"]
CONNECTION_KEY = [c for c in CONNECTION_RAW if c != "difficulty"]
FLOW_KEY = [c for c in CICIDS2017.columns if c not in CICIDS2017.dropped_columns]


def names(columns, prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{c}"' for c in columns)


def nonfinite(c: str) -> str:
    return f'coalesce(isnan("{c}") or isinf("{c}"), false)'


def imputed(c: str) -> str:
    return f'case when {nonfinite(c)} then cast(-1 as double) else "{c}" end'


def hashed(dataset: str, columns) -> str:
    parts = ", ".join(
        f"coalesce(concat(cast(length(cast({c} as varchar)) as varchar), ':', cast({c} as varchar)), '~')"
        for c in columns
    )
    return f"concat('{dataset}-', substr(sha256(concat({parts})), 1, 32))"


CONNECTION_FLAGS_SQL = {
    "failed_logins": "num_failed_logins >= 3",
    "land_attack": "land = 1",
    "root_privilege": "root_shell = 1 or num_root > 0",
    "high_connection_rate": '"count" >= 100',
    "high_error_rate": "serror_rate >= 0.5 or rerror_rate >= 0.5",
}
FLOW_FLAGS_SQL = {
    "zero_payload": "total_length_of_fwd_packets = 0 and total_length_of_bwd_packets = 0",
    "syn_flood_like": "syn_flag_count >= 1 and ack_flag_count = 0",
    "malicious_port": "destination_port = 4444 or destination_port = 31337 or destination_port = 1337 or destination_port = 6667",
    "asymmetric_flow": "total_backward_packets = 0",
}


def flag(condition: str) -> str:
    return f"case when {condition} then 1 else 0 end"


def flag_names(flags: dict[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"case when {c} then '{n}' end" for n, c in flags.items()) + ")"


def flag_list(flags: dict[str, str]) -> str:
    return ", ".join(f"{flag(c)} AS rule_flag_{n}" for n, c in flags.items())


CONNECTION_CATEGORY = """case attack_type when 'normal' then 'Benign' when 'neptune' then 'DoS'
    when 'satan' then 'Probe/Scan' when 'guess_passwd' then 'Brute Force'
    when 'rootkit' then 'Privilege Escalation' else 'Other' end"""
FLOW_CATEGORY = """case label when 'BENIGN' then 'Benign' when 'DDoS' then 'DoS'
    when 'PortScan' then 'Probe/Scan' else 'Other' end"""

_rates = CICIDS2017.rate_columns
_rank = "case source_day when 'monday' then 0 when 'wednesday' then 1 else 2 end"


def payload(columns, special: dict[str, str] = {}) -> str:
    """The columns as JSON text, some of them computed."""
    fields = ", ".join(f"""'{c}': {special.get(c, f'"{c}"')}""" for c in columns)
    return f"cast(to_json({{{fields}}}) as varchar)"


VIEWS = {
    "conn": duck_connections(),
    "flow": duck_flows(),
    "raw_conn": f"""SELECT {names(CONNECTION_RAW)} FROM conn UNION ALL
        SELECT {", ".join('difficulty + 10' if c == 'difficulty' else f'"{c}"' for c in CONNECTION_RAW)}
        FROM conn WHERE flag = 'R'""",
    "clean_conn": f"""SELECT {names(CONNECTION_KEY)}, min(difficulty) AS difficulty,
        case when attack_type = 'normal' then 0 else 1 end AS is_attack,
        {CONNECTION_CATEGORY} AS attack_category
        FROM raw_conn GROUP BY {names(CONNECTION_KEY)}""",
    "valid_flow": f"""SELECT * REPLACE ({", ".join(f'{imputed(c)} AS "{c}"' for c in _rates)})
        FROM flow WHERE flow_duration >= 0""",
    "dedup_flow": f"""SELECT {names(FLOW_KEY)}, source_day, split FROM (
        SELECT *, row_number() OVER (PARTITION BY {names(FLOW_KEY)} ORDER BY {_rank}) AS rn FROM valid_flow)
        WHERE rn = 1""",
    "pred": f"""SELECT *, case when label = 'BENIGN' then 0 else 1 end AS is_attack,
        {FLOW_CATEGORY} AS attack_category FROM flow""",
    "conn_pred": f"""SELECT *, case when attack_type = 'normal' then 0 else 1 end AS is_attack,
        {CONNECTION_CATEGORY} AS attack_category, duration / 100 AS attack_probability,
        case when src_bytes > 60000 then cast(1 as double) else cast(0 as double) end AS prediction
        FROM conn""",
    "served": f"""
        SELECT {hashed('nsl_kdd', CONNECTION_ID)} AS flow_id, 'nsl_kdd' AS dataset_source, split,
            cast(null as varchar) AS source_day, protocol_type AS protocol, duration,
            src_bytes AS bytes_sent, dst_bytes AS bytes_received, is_attack AS is_attack_actual,
            attack_category AS attack_category_actual, cast(prediction as int) AS predicted_label,
            attack_probability, {flag_names(CONNECTION_FLAGS_SQL)} AS rule_flags,
            {payload(NSL_KDD.features)} AS raw_features
        FROM conn_pred
        UNION ALL
        SELECT {hashed('cicids2017', ['event_id'])}, 'cicids2017', split, source_day,
            cast(null as varchar), cast(flow_duration as double), total_length_of_fwd_packets,
            total_length_of_bwd_packets, is_attack, attack_category, cast(prediction as int),
            attack_probability, {flag_names(FLOW_FLAGS_SQL)},
            {payload(CICIDS2017.features, {c: f"coalesce({imputed(c)}, -1)" for c in _rates})}
        FROM pred""",
    "curve_points": """
        SELECT b, sum(n) OVER (ORDER BY b DESC) AS cn, sum(p) OVER (ORDER BY b DESC) AS cp, sum(p) OVER () AS tp
        FROM (SELECT round(attack_probability / cast(0.05 as double)) * cast(0.05 as double) AS b,
              count(*) AS n, sum(is_attack) AS p FROM pred GROUP BY 1)""",
    "curve": """
        SELECT round(b, 5) AS threshold, round(pr, 5) AS "precision", round(re, 5) AS recall,
            round(case when pr + re = 0 then 0 else 2 * pr * re / (pr + re) end, 5) AS f1
        FROM (SELECT b, cast(cp as double) / cn AS pr,
              case when tp = 0 then cast(0 as double) else cast(cp as double) / tp end AS re FROM curve_points)""",
    "ranked": """
        SELECT s, p, n, sum(p) OVER (ORDER BY s DESC) AS cp, sum(n) OVER (ORDER BY s DESC) AS cn
        FROM (SELECT score AS s, sum(is_attack) AS p, sum(1 - is_attack) AS n FROM scored GROUP BY 1)""",
    # More distinct scores than one window slice: the mean packet size mixed in.
    "scored": "SELECT is_attack, attack_probability + flow_duration / cast(100000 as double) AS score FROM pred",
}


def twin(sql: str) -> str:
    """The statement with the WITH clauses it (transitively) names."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in needed) + " " + sql

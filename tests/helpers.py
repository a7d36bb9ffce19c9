"""Rows for the two raw layouts, with only the interesting columns given."""

from flowlake.sources.schema import raw_schema
from flowlake.specs import CICIDS2017, NSL_KDD


def connection(split=None, **values):
    row = {c: 0.0 for c in NSL_KDD.numeric}
    row.update(protocol_type="tcp", service="http", flag="SF", attack_type="normal", difficulty=10)
    row.update(values)
    return row if split is None else {**row, "split": split}


def flow(day=None, **values):
    row = {c: 0.0 for c in CICIDS2017.columns}
    row.update(destination_port=80, flow_duration=1000, label="BENIGN")
    row.update(values)
    if day is None:
        return row
    del row["fwd_header_length_dup"]
    return {**row, "source_day": day, "split": CICIDS2017.split_of(day)}


def frame(spark, spec, rows):
    extra = [c for c in rows[0] if c not in spec.columns]
    fields = [f for f in raw_schema(spec).fields if f.name in rows[0]]
    names = [f.name for f in fields] + extra
    ddl = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{c}` string" for c in extra]
    )
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ddl)


def connections(spark, rows):
    return frame(spark, NSL_KDD, rows)


def flows(spark, rows):
    return frame(spark, CICIDS2017, rows)


def csv_line(spec, row):
    return ",".join(str(row[c]) for c in spec.columns)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def long_report(df):
    return {(r["metric"], r["key"]): r["value"] for r in df.collect()}

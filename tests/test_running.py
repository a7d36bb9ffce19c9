"""Running totals over range partitions against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from flowlake.operators.running import running_totals


def by_loop(rows):
    """rows: (key, id, n) in order; the running sum and the rank by id."""
    out, total = {}, 0
    for rank, (_, i, n) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1):
        total += n or 0
        out[i] = (total, rank)
    return out


@pytest.mark.parametrize("partitions", [None, 1, 5, 40])
def test_totals_and_ranks(spark, partitions):
    rng = random.Random(3)
    # A third of the rows share one key; the id tells them apart.
    rows = [(7 if i % 3 == 0 else rng.randrange(50), i, rng.choice([None, 1, 2, 5])) for i in range(900)]
    df = spark.createDataFrame(rows, "key int, id long, n long").repartition(4)
    got = running_totals(df, [F.desc("key"), F.asc("id")], {"total": F.col("n"), "rank": F.lit(1).cast("long")}, partitions)
    assert got.columns == ["key", "id", "n", "total", "rank"]
    assert {r.id: (r.total, r["rank"]) for r in got.collect()} == by_loop(rows)


def test_one_partition_does_not_hold_a_hot_key(spark, tmp_path):
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 1, 0) AS key", "id")
    got = running_totals(df, [F.asc("key"), F.asc("id")], {"rank": F.lit(1).cast("long")}, 8)
    sizes = got.groupBy(F.floor((F.col("rank") - 1) / 5000)).agg(F.count("*").alias("n"), F.max("rank")).collect()
    assert [r.n for r in sizes] == [5000] * 4 and max(r[2] for r in sizes) == 20_000


def test_no_rows_and_equal_rows(spark):
    df = spark.createDataFrame([(1, 2)] * 4, "key int, n long")
    assert sorted(r.cum for r in running_totals(df, [F.asc("key")], {"cum": F.col("n")}).collect()) == [2, 4, 6, 8]
    assert running_totals(df.limit(0), [F.asc("key")], {"cum": F.col("n")}).count() == 0


def test_rows_carry_no_cut_points(spark):
    df = spark.range(100).selectExpr("id", "1L AS n")
    plan = running_totals(df, [F.asc("id")], {"cum": F.col("n")}, 4)._jdf.queryExecution().toString()
    assert "array" not in plan.lower() and "Window" in plan

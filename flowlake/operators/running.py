"""Running totals and ranks over an ordered table of any size.

The rows are range-partitioned on the order, so every partition holds one stretch
of it; a stretch's total is one row, the totals before it are its offset, and every
stretch runs its own window on top of that. No row is compared with cut points.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlake.session import scratch_path

STRETCH = "_stretch"


def running_totals(
    rows: DataFrame, order: Sequence[Column], totals: Mapping[str, Column], partitions: int | None = None
) -> DataFrame:
    """Adds a column for each of `totals` (name -> what is summed): its sum over this
    row and all rows before it in `order`, which should tell all rows apart: equal
    ones stay in one stretch and are counted in any order.

    The ordered rows are written once to the shared folder. Where a stretch begins
    is found by sampling, so offsets and windows must see the same division, also
    after a lost executor. Nulls count as 0.
    """
    spark = rows.sparkSession
    ordered = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    path = scratch_path(spark, "stretches")
    divided = ordered.withColumn(STRETCH, F.spark_partition_id())
    divided.write.parquet(path)
    stored = spark.read.schema(divided.schema).parquet(path)

    # One row for each partition, whatever the number of rows.
    each = stored.groupBy(STRETCH).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in totals.items()])
    found = sorted(each.collect())
    before = [accumulate([r[n] for r in found], initial=0) for n in totals]
    offsets = spark.createDataFrame(
        [(r[STRETCH], *start) for r, *start in zip(found, *before)],
        each.select(STRETCH, *[F.col(n).alias(f"_before_{n}") for n in totals]).schema,
    )
    inside = Window.partitionBy(STRETCH).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    both = stored.join(F.broadcast(offsets), STRETCH)
    return both.select(
        *rows.columns,
        *[(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_before_{n}")).alias(n) for n, c in totals.items()],
    )

"""Places in a global order without a task that sees every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refloom.operators.schema import free_name
from refloom.session import cut_lineage


def ordered_places(df: DataFrame, order: Sequence[Column], into: str) -> DataFrame:
    """``df`` plus ``into``: the place of each row in the order, from 1.

    Rows are dealt into ranges of the order; a place is the number of rows in earlier ranges
    plus the place inside the range. No task holds more than its range.
    """
    part = free_name("range", df.columns)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the bounds are sampled, so the ranges are written once
    dealt = cut_lineage(df.repartitionByRange(ranges, *order).withColumn(part, F.spark_partition_id()))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    counts = dealt.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(free_name("before", df.columns)))
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    place = F.col(before.columns[1]) + inside
    return dealt.join(F.broadcast(before), part).withColumn(into, place).drop(*before.columns)

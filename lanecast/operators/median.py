"""Exact median per group that never gathers one group into one task.

Rows are written once, range-partitioned and sorted by (keys, value, tie), each
with its place in that order.  Range partitions cut large groups, ties
included.  Counts of the few (partition, group) runs give each run's ranks;
the one or two middle ranks of a group are then places, and the rows at those
places hold the middle values.  One path for groups of every size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanecast.session import scratch_path

PLACE = "_place"  # partition << 33 | position in the partition


def ordered_rows(df: DataFrame, keys: list[str], value: str, tie: str | list[str]) -> DataFrame:
    """df in (keys, value, tie) order, stored in the shared folder, with PLACE."""
    order = [*keys, value, *([tie] if isinstance(tie, str) else tie)]
    path = scratch_path(df.sparkSession, "ordered")
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
       .withColumn(PLACE, F.monotonically_increasing_id()).write.parquet(path))
    return df.sparkSession.read.parquet(path)


def exact_median(rows: DataFrame, keys: list[str], value: str, out: str = "median") -> DataFrame:
    """(keys..., out) with the linear-interpolated median of ``value`` per
    group of ``ordered_rows``; equals ``F.median``.  NULL values are ignored,
    all-NULL groups are absent (they sort first, so places stay contiguous)."""
    known = rows.filter(F.col(value).isNotNull())
    runs = (known.groupBy(*keys, F.shiftright(PLACE, 33).alias("_part"))
            .agg(F.min(PLACE).alias("_first"), F.count(F.lit(1)).alias("_rows")))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    n = F.sum("_rows").over(group)
    middle = (runs.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).withColumn("_n", n)
              .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1))))
              .filter((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_rows")))
              .select(*keys, (F.col("_first") + F.col("_rank") - F.col("_before") - 1).alias(PLACE)))
    picked = known.select(PLACE, F.col(value).cast("double").alias("_v")).join(middle, PLACE)
    # same interpolation as Spark's percentile(0.5)
    return picked.groupBy(*keys).agg((F.min("_v") * 0.5 + F.max("_v") * 0.5).alias(out))

"""Mergeable partial aggregates of the mart, by month.

Reports over the whole mart (averages, spread, coverage, activity, distinct lanes)
need sums and sets that merge.  Three small tables keep them:

* `lane_month`: one row per month, equipment and lane with the number of days, the
  count, sum and squared deviations of the daily average, count and sum of the
  median, and the days that are covered;
* `region_week`: one row per month, week and pair of regions (a week may lie in two
  months; its two rows add up);
* `lane_bitmaps`: the lanes of a month and equipment as bitmaps over numbers of
  lanes, one row per 32,768 numbers; sets are united by `bitmap_or_agg`, so a lane
  counts once over any months.

Averages merge as sums over counts, the spread as squared deviations within the
parts plus those between their means (no difference of large squares).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANE_MONTH_KEY = ["valid_month", "equipment_id", "port_lane", "origin_port_name", "destination_port_name",
                  "origin_region_name", "destination_region_name"]
REGION_WEEK_KEY = ["valid_month", "week_start", "origin_region_name", "destination_region_name"]


def _total(value: str) -> list[Column]:
    name = value.split("_")[0]
    return [F.count(value).alias(f"n_{name}"), F.sum(value).alias(f"sum_{name}")]


def lane_month(mart: DataFrame) -> DataFrame:
    """States of the lanes; ``mart`` has valid_month.  Days without a flag are not covered."""
    return mart.groupBy(*LANE_MONTH_KEY).agg(
        F.count(F.lit(1)).alias("days"), *_total("avg_price_usd"), *_total("median_price_usd"),
        (F.var_pop("avg_price_usd") * F.count("avg_price_usd")).alias("m2_avg"),
        F.count_if("dq_ok").alias("days_ok"))


def region_week(mart: DataFrame) -> DataFrame:
    """States of the pairs of regions; weeks begin on Monday."""
    week = F.date_trunc("week", "valid_day").cast("date")
    return mart.withColumn("week_start", week).groupBy(*REGION_WEEK_KEY).agg(*_total("avg_price_usd"))


def new_lanes(lanes: DataFrame, known: DataFrame | None) -> DataFrame:
    """port_lane, lane_id of the lanes that have no number yet.  Numbers are never
    given twice and need not be dense; they are only fixed once they are stored."""
    fresh = lanes.select("port_lane").distinct()
    if known is None:
        return fresh.select("port_lane", F.monotonically_increasing_id().alias("lane_id"))
    after = known.agg(F.coalesce(F.max("lane_id") + 1, F.lit(0))).scalar()
    return (fresh.join(known.select("port_lane"), "port_lane", "left_anti")
            .select("port_lane", (F.monotonically_increasing_id() + after).alias("lane_id")))


def lane_bitmaps(states: DataFrame, numbers: DataFrame) -> DataFrame:
    """Bitmaps of the lanes of `lane_month` rows and of those with a covered day."""
    at, covered = F.bitmap_bit_position("lane_id"), F.col("days_ok") > 0
    return (states.select("valid_month", "equipment_id", "port_lane", "days_ok").join(numbers, "port_lane")
            .groupBy("valid_month", "equipment_id", F.bitmap_bucket_number("lane_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(at).alias("lanes"),
                 F.bitmap_construct_agg(F.when(covered, at)).alias("covered_lanes")))


# ---- merging -------------------------------------------------------------------


def mean(name: str) -> Column:
    """Average of the days of the merged rows; NULL without any."""
    return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}").cast("double"))


def spread(states: DataFrame, by: Column, name: str) -> DataFrame:
    """The group and the population standard deviation of its daily averages."""
    group = Window.partitionBy(name)
    whole = F.try_divide(F.sum("sum_avg").over(group), F.sum("n_avg").over(group).cast("double"))
    apart = F.try_divide(F.col("sum_avg"), F.col("n_avg").cast("double")) - F.col("_mean")
    return (states.withColumn(name, by).withColumn("_mean", whole).groupBy(name)
            .agg(F.sqrt(F.try_divide(F.sum(F.col("m2_avg") + F.col("n_avg") * apart * apart),
                                     F.sum("n_avg").cast("double"))).alias("spread")))


def distinct_lanes(bitmaps: DataFrame, by: list[str], lanes: str = "lanes") -> DataFrame:
    """The group and lane_count, the different lanes of its bitmaps; groups without a lane are absent."""
    return (bitmaps.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg(lanes)).alias("_n"))
            .groupBy(*by).agg(F.sum("_n").alias("lane_count")).filter(F.col("lane_count") > 0))

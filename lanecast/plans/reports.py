"""The saved analytical queries over the mart (one function each).

Every function takes the mart DataFrame (stored or lazy) plus typed
parameters and returns a DataFrame.  "Latest day" and "last 90 days" are
scalar subqueries, not cross joins: when the mart is the stored,
month-partitioned table, the same bound also prunes ``valid_month``
partitions at scan time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecast.functions.compat import lane_label

LANE_COLS = ["origin_port_name", "destination_port_name"]


def _max_day(mart: DataFrame) -> Column:
    """Latest day; of a month-partitioned mart only the latest month is read
    (the month itself comes from the partition folders)."""
    if "valid_month" in mart.columns:
        mart = mart.filter(F.col("valid_month") == mart.select(F.max("valid_month")).scalar())
    return mart.select(F.max("valid_day")).scalar()


def on_days(mart: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """valid_day BETWEEN lo AND hi, plus the matching partition predicate
    when the mart carries the ``valid_month`` partition column."""
    out = mart.filter(F.col("valid_day").between(lo, hi))
    if "valid_month" in mart.columns:
        out = out.filter(F.col("valid_month").between(F.trunc(lo, "month"), F.trunc(hi, "month")))
    return out


def _latest(mart: DataFrame) -> DataFrame:
    d = _max_day(mart)
    return on_days(mart, d, d)


def latest_by_lane(mart: DataFrame) -> DataFrame:
    """Q1: lanes on the latest day, most expensive median first."""
    return (_latest(mart)
            .select(lane_label().alias("lane"), "median_price_usd", "avg_price_usd")
            .orderBy(F.col("median_price_usd").desc_nulls_last()))


def latest_by_region(mart: DataFrame) -> DataFrame:
    """Q2: region pairs on the latest day."""
    return (_latest(mart).groupBy("origin_region_name", "destination_region_name")
            .agg(F.count(F.lit(1)).alias("lane_count"),
                 F.avg("avg_price_usd").alias("avg_of_avg_price"),
                 F.avg("median_price_usd").alias("avg_of_median_price"))
            .orderBy(F.col("avg_of_median_price").desc_nulls_last()))


def daily_avg_one_lane(mart: DataFrame, origin: str = "Shanghai",
                       destination: str = "Long Beach, CA") -> DataFrame:
    """Q3: daily average for one lane given by port names."""
    return (mart.filter((F.col("origin_port_name") == origin)
                        & (F.col("destination_port_name") == destination))
            .groupBy("valid_day").agg(F.avg("avg_price_usd").alias("daily_avg_price"))
            .orderBy("valid_day"))


def weekly_region_trend(mart: DataFrame) -> DataFrame:
    """Q4: weekly (Monday) average per region pair."""
    week = F.date_trunc("week", "valid_day").cast("date")
    return (mart.groupBy(week.alias("week_start"), "origin_region_name", "destination_region_name")
            .agg(F.avg("avg_price_usd").alias("weekly_avg_price"))
            .orderBy("week_start", F.col("weekly_avg_price").desc_nulls_last(),
                     F.col("origin_region_name").asc_nulls_last(),
                     F.col("destination_region_name").asc_nulls_last()))


def lane_monthly_avg(mart: DataFrame) -> DataFrame:
    return (mart.groupBy(F.trunc("valid_day", "month").alias("month"), *LANE_COLS)
            .agg(F.avg("avg_price_usd").alias("monthly_avg_price")))


def mom_change(mart: DataFrame) -> DataFrame:
    """Q5: month-over-month change per lane, as a fraction; NULL for a
    lane's first month and when the previous month averaged 0."""
    from pyspark.sql import Window
    w = Window.partitionBy(*LANE_COLS).orderBy("month")
    m = lane_monthly_avg(mart).withColumn("prev_month_price", F.lag("monthly_avg_price").over(w))
    prev = F.col("prev_month_price")
    change = (F.when(prev.isNull(), F.lit(None).cast("double"))
               .when(prev == 0, F.lit(None).cast("double"))
               .otherwise((F.col("monthly_avg_price") - prev) / prev))
    return (m.select("month", lane_label().alias("lane"), "monthly_avg_price", "prev_month_price",
                     change.alias("mom_change_pct"))
            .orderBy("month", "lane"))


def lane_monthly(mart: DataFrame) -> DataFrame:
    """Q6: monthly average and median-average per lane label."""
    return (mart.groupBy(F.trunc("valid_day", "month").alias("month"), lane_label().alias("lane"))
            .agg(F.avg("avg_price_usd").alias("avg_price"),
                 F.avg("median_price_usd").alias("median_price"))
            .orderBy("month", "lane"))


def latest_leaderboard(mart: DataFrame) -> DataFrame:
    """Q7: latest-day leaderboard (Q1 with other column order)."""
    return (_latest(mart)
            .select(lane_label().alias("lane"), "avg_price_usd", "median_price_usd")
            .orderBy(F.col("median_price_usd").desc_nulls_last()))


def region_monthly(mart: DataFrame) -> DataFrame:
    """Q8: monthly average per region pair."""
    return (mart.groupBy(F.trunc("valid_day", "month").alias("month"),
                         "origin_region_name", "destination_region_name")
            .agg(F.avg("avg_price_usd").alias("avg_price"))
            .orderBy("month", F.col("origin_region_name").asc_nulls_last(),
                     F.col("destination_region_name").asc_nulls_last()))


def origin_regions_90d(mart: DataFrame, destination_region: str = "Los Angeles Ports",
                       days: int = 90) -> DataFrame:
    """Q9: origin regions into one destination region over the last ``days``
    days of data (inclusive window ending at the latest day)."""
    hi = _max_day(mart)
    return (on_days(mart, F.date_add(hi, -days), hi)
            .filter(F.col("destination_region_name").like(destination_region))
            .groupBy("origin_region_name").agg(F.avg("avg_price_usd").alias("avg_price")))


def price_by_equipment(mart: DataFrame) -> DataFrame:
    """Q10: average price per equipment type."""
    return (mart.groupBy("equipment_id").agg(F.avg("avg_price_usd").alias("avg_price"))
            .orderBy(F.col("avg_price").desc_nulls_last()))


def lane_equipment_avg(mart: DataFrame) -> DataFrame:
    """Q11: lane x equipment averages (long format)."""
    return (mart.groupBy(*LANE_COLS, "equipment_id").agg(F.avg("avg_price_usd").alias("avg_price"))
            .orderBy(*[F.col(c).asc_nulls_last() for c in [*LANE_COLS, "equipment_id"]]))


def _by_lane_label(mart: DataFrame, agg: Column) -> DataFrame:
    return mart.groupBy(lane_label().alias("lane")).agg(agg)


def top10_lanes(mart: DataFrame, k: int = 10) -> DataFrame:
    """Q12: top-k lanes by average price (lane name breaks ties)."""
    return (_by_lane_label(mart, F.avg("avg_price_usd").alias("avg_price"))
            .orderBy(F.col("avg_price").desc_nulls_last(), "lane").limit(k))


def volatile_lanes(mart: DataFrame, k: int = 10) -> DataFrame:
    """Q13: top-k lanes by population stddev of the daily average."""
    return (_by_lane_label(mart, F.stddev_pop("avg_price_usd").alias("price_volatility"))
            .orderBy(F.col("price_volatility").desc_nulls_last(), "lane").limit(k))


def bad_data_rate(mart: DataFrame) -> DataFrame:
    """Q14: share of rows failing coverage per lane (NULL flag = failing)."""
    return (_by_lane_label(mart, F.avg(F.when(F.col("dq_ok"), 0).otherwise(1)).alias("bad_data_rate"))
            .orderBy(F.col("bad_data_rate").desc_nulls_last()))


def missing_price_rows(mart: DataFrame, k: int = 100) -> DataFrame:
    """Q15: up to k rows with a missing average or median (ordered by key)."""
    cols = [c for c in mart.columns if c != "valid_month"]
    return (mart.filter(F.col("avg_price_usd").isNull() | F.col("median_price_usd").isNull())
            .select(*cols)
            .orderBy("valid_day", "equipment_id", "origin_port_id", "destination_port_id").limit(k))


def lanes_by_equipment(mart: DataFrame) -> DataFrame:
    """Q16: distinct port lanes per equipment."""
    return mart.groupBy("equipment_id").agg(F.countDistinct("port_lane").alias("lane_count"))


def _lanes_by_month(mart: DataFrame) -> DataFrame:
    return (mart.groupBy(F.year("valid_day").cast("bigint").alias("v_year"),
                         F.month("valid_day").cast("bigint").alias("v_month"))
            .agg(F.countDistinct("port_lane").alias("lane_count"))
            .orderBy("v_year", "v_month"))


def lanes_by_month(mart: DataFrame) -> DataFrame:
    """Q17: distinct port lanes per year-month."""
    return _lanes_by_month(mart)


def valid_lanes_by_month(mart: DataFrame) -> DataFrame:
    """Q18: distinct covered port lanes per year-month."""
    return _lanes_by_month(mart.filter(F.col("dq_ok")))


def expensive_lanes(mart: DataFrame) -> DataFrame:
    """Q19: port lanes by average price."""
    return (mart.groupBy("port_lane").agg(F.avg("avg_price_usd").alias("avg_price"))
            .orderBy(F.col("avg_price").desc_nulls_last()))


def contract_days_by_lane(mart: DataFrame) -> DataFrame:
    """Q20: lane-day rows per port lane."""
    return (mart.groupBy("port_lane").agg(F.count("valid_day").alias("valid_days"))
            .orderBy(F.col("valid_days").desc()))


def origin_activity(mart: DataFrame) -> DataFrame:
    """Q21: rows per origin port (non-distinct count of destinations)."""
    return (mart.groupBy("origin_port_name")
            .agg(F.count("destination_port_name").alias("destination_ports"))
            .orderBy(F.col("destination_ports").desc()))


def destination_activity(mart: DataFrame) -> DataFrame:
    """Q22: rows per destination port (non-distinct count of origins)."""
    return (mart.groupBy("destination_port_name")
            .agg(F.count("origin_port_name").alias("origin_ports"))
            .orderBy(F.col("origin_ports").desc()))

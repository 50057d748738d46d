"""Dashboard page queries as parameterised DataFrame functions.

The pages substitute text into SQL (``'%'`` or NULL meaning "no filter");
here parameters are typed arguments.  ``None`` / ``'%'`` keep every non-NULL
value, exactly as the substituted LIKE / coalesce predicates do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.functions.compat import (as_date, concat_text, lane_label, like_or_all,
                                       optional_eq, percent)
from lanecast.plans.reports import on_days


def _covered(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("dq_ok") == F.lit(True))


def _range(mart: DataFrame, start, end) -> DataFrame:
    return on_days(mart, as_date(start), as_date(end))


def daily_shipping_prices(mart: DataFrame, equipment_id=None) -> DataFrame:
    """Covered lane-days with a lane description."""
    return (_covered(mart).filter(optional_eq("equipment_id", equipment_id))
            .select("valid_day", "equipment_id", "origin_region_name", "destination_region_name",
                    "origin_port_name", "destination_port_name", "avg_price_usd",
                    "median_price_usd", "dq_ok", lane_label().alias("lane_description"))
            .orderBy("valid_day", "equipment_id",
                     F.col("origin_region_name").asc_nulls_last(),
                     F.col("destination_region_name").asc_nulls_last()))


def dq_summary(mart: DataFrame) -> DataFrame:
    """Covered vs uncovered lane-days per day."""
    return (mart.groupBy("valid_day")
            .agg(F.count_if(F.col("dq_ok") == F.lit(True)).alias("covered_lanes"),
                 F.count_if(F.col("dq_ok") == F.lit(False)).alias("uncovered_lanes"))
            .orderBy("valid_day"))


def dq_failures(mart: DataFrame) -> DataFrame:
    """D3: lane-days failing the coverage rule, with their counts."""
    return (mart.filter(F.col("dq_ok") == F.lit(False))
            .select("valid_day", "equipment_id", "origin_port_name", "destination_port_name",
                    "distinct_companies_count", "distinct_suppliers_count")
            .orderBy("valid_day", "equipment_id"))


def data_coverage(mart: DataFrame, equipment_id=None) -> DataFrame:
    """Per day, total and reliable lane-days and the reliable percent."""
    reliable = F.count(F.when(F.col("dq_ok"), F.lit(1)))
    return (mart.filter(optional_eq("equipment_id", equipment_id))
            .groupBy("valid_day")
            .agg(F.count(F.lit(1)).alias("total_lane_days"), reliable.alias("reliable_lane_days"))
            .withColumn("pct_reliable", percent("reliable_lane_days", "total_lane_days"))
            .orderBy("valid_day"))


def dq_failure_reason(mart: DataFrame, after="2022-01-01", min_companies: int = 5,
                      min_suppliers: int = 2) -> DataFrame:
    """Why a failing lane-day fails (companies checked first)."""
    issue = (F.when(F.col("distinct_companies_count") < min_companies, F.lit("Needs more companies"))
              .when(F.col("distinct_suppliers_count") < min_suppliers, F.lit("Needs more suppliers"))
              .otherwise(F.lit("OK")))
    out = mart.filter((F.col("dq_ok") == F.lit(False)) & (F.col("valid_day") > as_date(after)))
    if "valid_month" in mart.columns:
        out = out.filter(F.col("valid_month") >= F.trunc(as_date(after), "month"))
    return (out.select("valid_day", "origin_port_code", "destination_port_code", "equipment_id",
                       issue.alias("dq_issue"), "distinct_companies_count")
            .orderBy("valid_day", F.col("distinct_companies_count").desc())
            .drop("distinct_companies_count"))


def port_pair_series(mart: DataFrame, origin_code="%", destination_code="%", equipment_id=None,
                     start="1900-01-01", end="9999-12-31") -> DataFrame:
    """Covered price series of a port pair (codes are LIKE patterns)."""
    return (_range(_covered(mart), start, end)
            .filter(like_or_all("origin_port_code", origin_code)
                    & like_or_all("destination_port_code", destination_code)
                    & optional_eq("equipment_id", equipment_id))
            .select("valid_day", "avg_price_usd", "median_price_usd")
            .orderBy("valid_day"))


def avg_median_gap(mart: DataFrame, origin_code="%", destination_code="%",
                   equipment_id=None) -> DataFrame:
    """Average minus median for a port pair."""
    return (_covered(mart)
            .filter(like_or_all("origin_port_code", origin_code)
                    & like_or_all("destination_port_code", destination_code)
                    & optional_eq("equipment_id", equipment_id))
            .select("valid_day", "avg_price_usd", "median_price_usd",
                    (F.col("avg_price_usd") - F.col("median_price_usd")).alias("avg_median_diff"))
            .orderBy("valid_day"))


def region_pair_series(mart: DataFrame, origin_region="%", destination_region="%",
                       equipment_id=None, start="1900-01-01", end="9999-12-31") -> DataFrame:
    """Per day, unweighted mean of covered port-pair averages between two
    regions and the number of port pairs behind it."""
    return (_range(_covered(mart), start, end)
            .filter(like_or_all("origin_region_name", origin_region)
                    & like_or_all("destination_region_name", destination_region)
                    & optional_eq("equipment_id", equipment_id))
            .groupBy("valid_day")
            .agg(F.avg("avg_price_usd").alias("region_avg_price_usd"),
                 F.count(F.lit(1)).alias("number_of_underlying_lanes"))
            .orderBy("valid_day"))


def most_expensive_lanes(mart: DataFrame, start="1900-01-01", end="9999-12-31",
                         equipment_id=None, k: int = 20) -> DataFrame:
    """The k most expensive covered lane-days in a date range (mart key
    breaks ties so the cut is deterministic)."""
    return (_range(_covered(mart), start, end)
            .filter(optional_eq("equipment_id", equipment_id))
            .orderBy(F.col("avg_price_usd").desc_nulls_last(), "valid_day", "equipment_id",
                     "origin_port_id", "destination_port_id")
            .limit(k)
            .select("origin_port_name", "origin_region_name", "destination_port_name",
                    "destination_region_name", "avg_price_usd",
                    lane_label().alias("lane_description")))


def country_lanes(mart: DataFrame, destination_country="%", start="1900-01-01",
                  end="9999-12-31") -> DataFrame:
    """Covered lanes into a destination country code (LIKE pattern)."""
    return (_range(_covered(mart), start, end)
            .filter(like_or_all("destination_country_code", destination_country))
            .select("valid_day", "origin_country_code", "origin_port_code", "equipment_id",
                    "avg_price_usd")
            .orderBy(F.col("avg_price_usd").desc_nulls_last()))


# ---- D11 filter value lists (distinct values of staged tables) -----------

def equipment_types(datapoints: DataFrame) -> DataFrame:
    return datapoints.select("equipment_id").distinct().orderBy("equipment_id")


def port_codes(ports: DataFrame) -> DataFrame:
    return ports.select("code").distinct().orderBy("code")


def region_names(regions: DataFrame) -> DataFrame:
    return regions.select("name").distinct()


def country_codes(ports: DataFrame) -> DataFrame:
    return ports.select("country_code").distinct()


def lane_list(datapoints: DataFrame) -> DataFrame:
    """Origin - destination id pairs of staged contracts.  (The page query
    repeats the origin id twice; the intended pair is built here.)"""
    return (datapoints.select("origin_port_id", "destination_port_id").distinct()
            .select(concat_text("origin_port_id", F.lit(" - "), "destination_port_id")
                    .alias("lane_description"))
            .orderBy("lane_description"))


def coverage_log(coverage: DataFrame) -> DataFrame:
    """Coverage snapshots, newest first."""
    return coverage.select("snapshot_ts", "stage", "covered_lane_count") \
                   .orderBy(F.col("snapshot_ts").desc())

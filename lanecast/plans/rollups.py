"""The mart's partial aggregates as stored tables, and the reports read from them.

`refresh` compares, from the manifests alone, the segments each month of the mart
is made of with those its stored states were made from, and recomputes the months
that differ: after an increment the touched ones, after a lost run whatever it left
behind, and nothing when all is current.  One refresh of a root at a time, as for
every table; readers see each table's last complete version.

The reports take the `Rollups` and have the columns and rows of their namesakes in
`plans.reports`, which read the daily rows.
"""

from __future__ import annotations

import hashlib
import threading
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanecast.functions.compat import lane_label
from lanecast.operators import rollup as U
from lanecast.plans import pipeline as P
from lanecast.plans.reports import LANE_COLS
from lanecast.sources import tables as TB

LAYER = "rollup"
STATES, WEEKS, BITMAPS, NUMBERS = "lane_month", "region_week", "lane_bitmaps", "lane_numbers"
SOURCE = "rollup_source"  # of a month: names the segments its states were made from

_lock = threading.Lock()


@dataclass(frozen=True)
class Rollups:
    lane_month: DataFrame
    region_week: DataFrame
    lane_bitmaps: DataFrame


class StoredRollups:
    """The `Rollups` below a root; a table's files are listed only when it is asked for."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root

    def _read(self, name: str) -> DataFrame:
        return TB.read(self._spark, TB.table_path(self._root, LAYER, name)).drop(SOURCE)

    lane_month = property(lambda self: self._read(STATES))
    region_week = property(lambda self: self._read(WEEKS))
    lane_bitmaps = property(lambda self: self._read(BITMAPS))


def _sources(spark: SparkSession, mart_path: str) -> dict[str, str]:
    """A digest of the segments that make up each month of the mart."""
    return {m: hashlib.sha256(" ".join(ids).encode()).hexdigest()[:32]
            for m, ids in TB.partition_segments(spark, mart_path).items()}


def _stale(spark: SparkSession, now: dict[str, str], path: str) -> tuple[list[str], list[str]]:
    """Months to compute, and months to take out of the table at ``path``."""
    done = TB.partition_marks(spark, path, SOURCE)
    return sorted(m for m in now if done.get(m) != now[m]), sorted(m for m in done if done[m] != now.get(m))


def _months(df: DataFrame, months: list[str]) -> DataFrame:
    return df.filter(F.col("valid_month").isin([F.lit(m).cast("date") for m in months]))


def _bring(spark: SparkSession, now: dict[str, str], path: str, rows_of) -> None:
    """Replace the stale months of one table by ``rows_of(months)``."""
    fresh, gone = _stale(spark, now, path)
    if not fresh and not gone:
        return
    name = F.create_map(*[F.lit(x) for m in fresh or [""] for x in (m, now.get(m, ""))])
    rows = rows_of(fresh).withColumn(SOURCE, name[F.col("valid_month").cast("string")])
    if TB.exists(spark, path):
        TB.replace_partitions(rows, path, gone=gone)
    else:
        TB.overwrite(rows, path, partition_by=["valid_month"])


def refresh(spark: SparkSession, root: str) -> None:
    """Bring the states below ``root`` up to date with the stored mart."""
    mart_path = TB.table_path(root, *P.MART_TABLE)
    at = partial(TB.table_path, root, LAYER)
    now = _sources(spark, mart_path)

    def from_mart(states_of, months: list[str]) -> DataFrame:
        return states_of(_months(P.read_mart(spark, mart_path), months))

    P.together(partial(_bring, spark, now, at(STATES), partial(from_mart, U.lane_month)),
               partial(_bring, spark, now, at(WEEKS), partial(from_mart, U.region_week)))

    def bitmaps(months: list[str]) -> DataFrame:
        states = _months(TB.read(spark, at(STATES)), months)
        known = TB.read(spark, at(NUMBERS)) if TB.exists(spark, at(NUMBERS)) else None
        TB.append(U.new_lanes(states, known), at(NUMBERS))  # stored before they are used
        return U.lane_bitmaps(states, TB.read(spark, at(NUMBERS)))

    _bring(spark, now, at(BITMAPS), bitmaps)


def current(spark: SparkSession, root: str) -> StoredRollups:
    """The states, refreshed first where the mart has changed."""
    refresh(spark, root)
    return StoredRollups(spark, root)


def fixture_rollups(spark: SparkSession, sf_dir: str) -> StoredRollups:
    """States of the fixture mart; computed at first use, then found current."""
    root = P.materialised_root(spark, sf_dir)
    if TB.manifest(spark, TB.table_path(root, *P.MART_TABLE)) is None:
        P.materialised_mart(spark, sf_dir)
    with _lock:
        return current(spark, root)


# ---- reports ---------------------------------------------------------------------


def weekly_region_trend(r: Rollups) -> DataFrame:
    """Q4."""
    return (r.region_week.groupBy("week_start", "origin_region_name", "destination_region_name")
            .agg(U.mean("avg").alias("weekly_avg_price"))
            .orderBy("week_start", F.col("weekly_avg_price").desc_nulls_last(),
                     F.col("origin_region_name").asc_nulls_last(), F.col("destination_region_name").asc_nulls_last()))


def mom_change(r: Rollups) -> DataFrame:
    """Q5; NULL for a lane's first month and after a month that averaged 0."""
    months = (r.lane_month.groupBy(F.col("valid_month").alias("month"), *LANE_COLS)
              .agg(U.mean("avg").alias("monthly_avg_price"))
              .withColumn("prev_month_price", F.lag("monthly_avg_price").over(Window.partitionBy(*LANE_COLS).orderBy("month"))))
    before = F.nullif("prev_month_price", F.lit(0.0))
    return (months.select("month", lane_label().alias("lane"), "monthly_avg_price", "prev_month_price",
                          F.try_divide(F.col("monthly_avg_price") - before, before).alias("mom_change_pct"))
            .orderBy("month", "lane"))


def lane_monthly(r: Rollups) -> DataFrame:
    """Q6."""
    return (r.lane_month.groupBy(F.col("valid_month").alias("month"), lane_label().alias("lane"))
            .agg(U.mean("avg").alias("avg_price"), U.mean("median").alias("median_price")).orderBy("month", "lane"))


def region_monthly(r: Rollups) -> DataFrame:
    """Q8."""
    regions = ["origin_region_name", "destination_region_name"]
    return (r.region_week.groupBy(F.col("valid_month").alias("month"), *regions).agg(U.mean("avg").alias("avg_price"))
            .orderBy("month", *[F.col(c).asc_nulls_last() for c in regions]))


def price_by_equipment(r: Rollups) -> DataFrame:
    """Q10."""
    return (r.lane_month.groupBy("equipment_id").agg(U.mean("avg").alias("avg_price"))
            .orderBy(F.col("avg_price").desc_nulls_last()))


def lane_equipment_avg(r: Rollups) -> DataFrame:
    """Q11."""
    key = [*LANE_COLS, "equipment_id"]
    return (r.lane_month.groupBy(*key).agg(U.mean("avg").alias("avg_price"))
            .orderBy(*[F.col(c).asc_nulls_last() for c in key]))


def top10_lanes(r: Rollups, k: int = 10) -> DataFrame:
    """Q12 (the lane's name breaks ties)."""
    return (r.lane_month.groupBy(lane_label().alias("lane")).agg(U.mean("avg").alias("avg_price"))
            .orderBy(F.col("avg_price").desc_nulls_last(), "lane").limit(k))


def volatile_lanes(r: Rollups, k: int = 10) -> DataFrame:
    """Q13 (the lane's name breaks ties)."""
    return (U.spread(r.lane_month, lane_label(), "lane").withColumnRenamed("spread", "price_volatility")
            .orderBy(F.col("price_volatility").desc_nulls_last(), "lane").limit(k))


def bad_data_rate(r: Rollups) -> DataFrame:
    """Q14."""
    failing = F.sum(F.col("days") - F.col("days_ok")).cast("double") / F.sum("days")
    return (r.lane_month.groupBy(lane_label().alias("lane")).agg(failing.alias("bad_data_rate"))
            .orderBy(F.col("bad_data_rate").desc_nulls_last()))


def lanes_by_equipment(r: Rollups) -> DataFrame:
    """Q16."""
    return U.distinct_lanes(r.lane_bitmaps, ["equipment_id"])


def _by_month(r: Rollups, lanes: str) -> DataFrame:
    return (U.distinct_lanes(r.lane_bitmaps, ["valid_month"], lanes)
            .select(F.year("valid_month").cast("bigint").alias("v_year"),
                    F.month("valid_month").cast("bigint").alias("v_month"), "lane_count")
            .orderBy("v_year", "v_month"))


def lanes_by_month(r: Rollups) -> DataFrame:
    """Q17."""
    return _by_month(r, "lanes")


def valid_lanes_by_month(r: Rollups) -> DataFrame:
    """Q18; months without a covered day are absent."""
    return _by_month(r, "covered_lanes")


def expensive_lanes(r: Rollups) -> DataFrame:
    """Q19."""
    return (r.lane_month.groupBy("port_lane").agg(U.mean("avg").alias("avg_price"))
            .orderBy(F.col("avg_price").desc_nulls_last()))


def contract_days_by_lane(r: Rollups) -> DataFrame:
    """Q20."""
    return (r.lane_month.groupBy("port_lane").agg(F.sum("days").alias("valid_days"))
            .orderBy(F.col("valid_days").desc()))


def _activity(r: Rollups, by: str, counted: str, name: str) -> DataFrame:
    days = F.when(F.col(counted).isNotNull(), F.col("days")).otherwise(0)
    return r.lane_month.groupBy(by).agg(F.sum(days).alias(name)).orderBy(F.col(name).desc())


def origin_activity(r: Rollups) -> DataFrame:
    """Q21."""
    return _activity(r, "origin_port_name", "destination_port_name", "destination_ports")


def destination_activity(r: Rollups) -> DataFrame:
    """Q22."""
    return _activity(r, "destination_port_name", "origin_port_name", "origin_ports")

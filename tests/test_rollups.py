"""Stored partial aggregates: equal to the reports over daily rows, after a full
build, an increment and a lost refresh; only touched months are computed again."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from lanecast.operators import rollup as U
from lanecast.plans import pipeline as P
from lanecast.plans import reports as R
from lanecast.plans import rollups as RU
from lanecast.session import scratch_path
from lanecast.sources import fixtures as fx
from lanecast.sources import tables as TB
from tests.conftest import SF_SMALL

REPORTS = ["weekly_region_trend", "mom_change", "lane_monthly", "region_monthly", "price_by_equipment",
           "lane_equipment_avg", "top10_lanes", "volatile_lanes", "bad_data_rate", "lanes_by_equipment",
           "lanes_by_month", "valid_lanes_by_month", "expensive_lanes", "contract_days_by_lane",
           "origin_activity", "destination_activity"]


def _rows(df):
    key = lambda r: [str(round(v, 3)) if isinstance(v, float) else str(v) for v in r]
    return sorted((tuple(r) for r in df.collect()), key=key)


def _same(a, b):
    assert a.columns == b.columns
    x, y = _rows(a), _rows(b)
    assert len(x) == len(y)
    for r, s in zip(x, y):
        for v, w in zip(r, s):
            assert v == w or math.isclose(v, w, rel_tol=1e-9, abs_tol=1e-7), (r, s)


@pytest.fixture(scope="module")
def built(spark):
    root = scratch_path(spark, "test-rollups")
    b1, b2 = fx.batches(spark, SF_SMALL)
    P.run_full(spark, b1, root, fx.BATCH1_LOAD_DATE)
    RU.refresh(spark, root)
    return root, b2


def _versions(spark, root):
    return {n: TB.manifest(spark, TB.table_path(root, RU.LAYER, n)) for n in (RU.STATES, RU.WEEKS, RU.BITMAPS, RU.NUMBERS)}


def test_increment_touches_its_months_and_a_lost_refresh_is_made_up(spark, built, monkeypatch):
    root, b2 = built
    before = _versions(spark, root)
    RU.refresh(spark, root)
    assert _versions(spark, root) == before  # nothing to do, nothing written

    old = TB.partition_segments(spark, TB.table_path(root, *P.MART_TABLE))
    P.run_incremental(spark, b2, root, fx.BATCH2_LOAD_DATE, P.SNAPSHOT_TS)
    new = TB.partition_segments(spark, TB.table_path(root, *P.MART_TABLE))
    touched = {m for m in new if new[m] != old.get(m)}
    assert touched and touched < set(new)

    with monkeypatch.context() as m:  # lost between the states and the bitmaps
        m.setattr(U, "lane_bitmaps", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            RU.refresh(spark, root)
    RU.refresh(spark, root)
    after = _versions(spark, root)
    for name in (RU.STATES, RU.WEEKS, RU.BITMAPS):
        assert {x["part"] for x in after[name].segments[-1]["stats"]} == touched
        assert after[name].segments[0]["id"] == before[name].segments[0]["id"]
    numbers = TB.read(spark, TB.table_path(root, RU.LAYER, RU.NUMBERS))
    n = numbers.count()
    assert numbers.select("port_lane").distinct().count() == numbers.select("lane_id").distinct().count() == n


@pytest.mark.parametrize("report", REPORTS)
def test_reports_equal_those_over_daily_rows(spark, built, report):
    root, _ = built
    _same(getattr(RU, report)(RU.current(spark, root)), getattr(R, report)(P.stored_mart(spark, root)))


def test_reports_do_not_read_the_mart(spark, built):
    root, _ = built
    r = RU.current(spark, root)
    for report in REPORTS:
        files = getattr(RU, report)(r).inputFiles()
        assert files and all(f"/{RU.LAYER}/" in f for f in files)


MART = ("valid_day date, valid_month date, equipment_id long, port_lane string, origin_port_name string, destination_port_name string, "
        "origin_region_name string, destination_region_name string, avg_price_usd double, median_price_usd double, dq_ok boolean")


def _mart(spark, rows):
    cols = ["d", "equipment_id", "o", "t", "avg_price_usd", "median_price_usd", "dq_ok"]
    df = spark.createDataFrame(rows, "d string, equipment_id long, o string, t string, avg_price_usd double, median_price_usd double, dq_ok boolean")
    assert df.columns == cols
    lane = F.concat_ws("", "o", F.lit(" to "), "t")
    return df.select(F.col("d").cast("date").alias("valid_day"), F.trunc(F.col("d").cast("date"), "month").alias("valid_month"),
                     "equipment_id", lane.alias("port_lane"), F.col("o").alias("origin_port_name"), F.col("t").alias("destination_port_name"),
                     F.col("o").alias("origin_region_name"), F.lit(None).cast("string").alias("destination_region_name"),
                     "avg_price_usd", "median_price_usd", "dq_ok")


def _states(spark, mart):
    states = U.lane_month(mart)
    return RU.Rollups(states, U.region_week(mart), U.lane_bitmaps(states, U.new_lanes(states, None)))


def test_nulls_ties_and_empty(spark):
    rows = [("2024-01-31", 1, "A", "B", None, None, None), ("2024-02-01", 1, "A", "B", 10.0, 0.0, True),
            ("2024-02-01", None, "A", "B", 10.0, 4.0, False), ("2024-02-02", 2, "C", None, 0.0, None, False),
            ("2024-03-01", 2, "C", None, 5.0, 5.0, True), ("2024-03-02", 2, None, "D", None, 1.0, None)]
    for mart in (_mart(spark, rows), _mart(spark, rows).limit(0)):
        for report in REPORTS:
            _same(getattr(RU, report)(_states(spark, mart)), getattr(R, report)(mart))


def test_spread_of_close_large_values(spark):
    values = [1e9 + x for x in (0.01, 0.02, 0.03, 0.05, 0.08, 0.13)]
    mart = _mart(spark, [(f"2024-0{1 + i % 3}-01", i % 2, "A", "B", v, v, True) for i, v in enumerate(values)])
    got = U.spread(U.lane_month(mart), F.col("port_lane"), "lane").first()["spread"]
    assert math.isclose(got, statistics.pstdev(values), rel_tol=1e-5)


def test_lanes_of_many_buckets_count_once(spark):
    ids = [0, 1, 32768, 32769, 65536, 1 << 33, (1 << 33) + 7]
    numbers = spark.createDataFrame([(f"L{i}", i) for i in ids], "port_lane string, lane_id long")
    states = spark.createDataFrame([(f"2024-0{m}-01", e, f"L{i}", int(i % 2)) for m in (1, 2) for e in (1, 2) for i in ids],
                                   "m string, equipment_id long, port_lane string, days_ok long").withColumn("valid_month", F.col("m").cast("date"))
    maps = U.lane_bitmaps(states, numbers)
    assert {r["equipment_id"]: r["lane_count"] for r in U.distinct_lanes(maps, ["equipment_id"]).collect()} == {1: 7, 2: 7}
    covered = U.distinct_lanes(maps, ["valid_month"], "covered_lanes").collect()
    assert [r["lane_count"] for r in covered] == [sum(i % 2 for i in ids)] * 2

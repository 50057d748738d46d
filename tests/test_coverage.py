"""Coverage change view: pairing edge cases, checked against the oracle's
theta-join + QUALIFY formulation in DuckDB."""

import datetime as dt

import duckdb

from lanecast import schemas
from lanecast.operators.coverage import coverage_changes
from lanecast.plans.oracle import COVERAGE_CHANGES_SQL

T = dt.datetime
LOG = [
    (T(2025, 1, 1, 10), "before", 10), (T(2025, 1, 1, 11), "after", 12),   # a pair
    (T(2025, 1, 2, 10), "before", 0), (T(2025, 1, 2, 11), "after", 5),     # zero before
    (T(2025, 1, 3, 10), "before", 7),                                      # next after is far later
    (T(2025, 1, 31, 23), "before", 8),                                     # across a month boundary
    (T(2025, 2, 1, 1), "after", 9), (T(2025, 2, 1, 2), "after", 11),       # two afters
    (T(2025, 3, 1, 0), "before", 4),                                       # no after at all
    (T(2025, 3, 1, 0), "after", 4),                                        # same ts: not later
]


def test_coverage_changes_matches_oracle(spark):
    df = spark.createDataFrame(LOG, schemas.COVERAGE)
    got = sorted(tuple(r) for r in coverage_changes(df).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE cov (snapshot_ts TIMESTAMP, stage VARCHAR, covered_lane_count BIGINT)")
    con.executemany("INSERT INTO cov VALUES (?, ?, ?)", LOG)
    want = sorted(tuple(r) for r in con.sql("WITH x AS (SELECT 1)" + COVERAGE_CHANGES_SQL.format(log="cov")).fetchall())
    assert got == want
    assert len(got) == 4
    zero = [r for r in got if r[2] == 0][0]
    assert zero[5] is None


def test_long_log_in_one_month(spark):
    """A long log within a month: the running frame pairs what a sorted pass in
    plain Python pairs, without an unpartitioned window."""
    import bisect

    from pyspark.sql import functions as F
    rows = 200_000
    at = F.timestamp_seconds(F.lit(1_735_689_600) + (F.col("id") * 7919) % 2_000_000).cast("timestamp_ntz")
    log = spark.range(rows).select(at.alias("snapshot_ts"), F.when(F.col("id") % 3 == 0, "after").otherwise("before").alias("stage"),
                                   (F.col("id") % 1000).alias("covered_lane_count"))
    changes = coverage_changes(log)
    assert "SinglePartition" not in changes.drop("pct_change")._jdf.queryExecution().executedPlan().toString().split("Sort [")[-1]
    got = {r.before_ts: (r.after_ts, r.before_count, r.after_count) for r in changes.collect()}
    everything = log.collect()
    afters = sorted((r.snapshot_ts, r.covered_lane_count) for r in everything if r.stage == "after")
    want = {}
    for r in everything:
        if r.stage == "before":
            i = bisect.bisect_right(afters, (r.snapshot_ts, float("inf")))
            if i < len(afters):
                n = max(r.covered_lane_count, want.get(r.snapshot_ts, (None, -1))[1])
                want[r.snapshot_ts] = (afters[i][0], n, afters[i][1])
    assert got == want and len(want) > 100_000

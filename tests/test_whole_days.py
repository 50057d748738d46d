"""Queries over the mart and the batches answer for every contract-day: what a last
day (2001-08-10), once in code and SQL, left out is in the answer of each of them."""

import datetime as dt
import math
import random

from lanecast.plans import catalog

QUERIES = """daily_avg_one_lane weekly_region_trend mom_change lane_monthly region_monthly price_by_equipment
lane_equipment_avg top10_lanes volatile_lanes bad_data_rate lanes_by_month valid_lanes_by_month expensive_lanes
contract_days origin_activity destination_activity daily_shipping_prices daily_shipping_prices_eq2 dq_summary
dq_failures data_coverage data_coverage_eq1 dq_failure_reason avg_median_gap stg_increment affected_window
affected_window_expand mart_upsert coverage_snapshot coverage_log coverage_changes""".split()


def plain(rows):
    """Rows without their order; dates as text."""
    fixed = [tuple(x.isoformat() if isinstance(x, dt.date) else x for x in r) for r in rows]
    return sorted(fixed, key=lambda r: [round(x, 2) if isinstance(x, float) else str(x) for x in r])


def same(a, b):
    return len(a) == len(b) and all(math.isclose(x, y, rel_tol=1e-9) if isinstance(x, float) else x == y
                                    for r, s in zip(a, b) for x, y in zip(r, s, strict=True))


def test_each_query_has_the_days_after_the_old_last_day(spark, duck, tmp_path):
    rng = random.Random(2)
    day = lambda k: dt.datetime(1999, 12, 1) if k < 60 else dt.datetime(2001, 8, 1) + dt.timedelta(days=k % 9)
    orders = [(k, rng.choice((5, 12, 13, 14, 15, 17, 24, 26, 29, 39, 41, 52, 65, 78, 104)), day(k)) for k in range(1, 900)]
    lines = [(k, n, rng.randrange(1, 50), "ANR"[rng.randrange(3)], rng.randrange(100, 90_000) / 8) for k, *_ in orders for n in (1, 2, 3)]
    for name, rows, kind in (("orders", orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"),
                             ("lineitem", lines, "l_orderkey bigint, l_linenumber int, l_quantity int, l_returnflag string, l_extendedprice double"),
                             ("region", [(i, f"REGION_{i}") for i in range(5)], "r_regionkey int, r_name string"),
                             ("nation", [(i, f"NATION_{i}", i % 5) for i in range(25)], "n_nationkey int, n_name string, n_regionkey int")):
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    con = duck("/root/testdata/sf0.001").cursor()
    for t in ("orders", "lineitem", "region", "nation"):
        con.execute(f"CREATE TEMP VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    for q in QUERIES:
        sql = catalog.ORACLE[q]
        cut = sql.replace("(SELECT *, row_number() OVER (PARTITION BY d_id",
                          "(SELECT * REPLACE (least(valid_to, DATE '2001-08-10') AS valid_to), row_number() OVER (PARTITION BY d_id")
        want = plain(con.sql(sql).fetchall())
        assert cut != sql and not same(plain(con.sql(cut).fetchall()), want), q
        assert same(plain(map(tuple, catalog.QUERIES[q](spark, str(tmp_path)).collect())), want), q

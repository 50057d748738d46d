"""The exact median equals a brute-force median, including a group that holds
most of the rows and spans many partitions; so does a mart with one busy lane."""

import random
import statistics

from pyspark.sql import functions as F

from lanecast.operators import mart as M
from lanecast.operators.median import exact_median, ordered_rows


def test_exact_median_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    # one hot group with many duplicates and a long tail, plus small groups
    rows += [("hot", 1, float(rnd.choice([5, 5, 5, 7, 9]) + rnd.random() * (i % 3))) for i in range(6000)]
    rows += [("hot", 2, float(rnd.randint(0, 50))) for _ in range(2001)]
    for g in range(40):
        for _ in range(rnd.randint(1, 9)):
            rows.append((f"g{g}", g % 3, float(rnd.randint(-20, 20)) / 4))
    rows += [("nulls", 0, None), ("nulls", 0, None), ("mixed", 0, None), ("mixed", 0, 3.0)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "k string, e int, v double, i int")
    df = ordered_rows(df, ["k", "e"], "v", "i")
    got = {(r.k, r.e): r.median for r in exact_median(df, ["k", "e"], "v").collect()}

    want = {}
    for (k, e) in {(k, e) for k, e, _ in rows}:
        vals = [v for kk, ee, v in rows if (kk, ee) == (k, e) and v is not None]
        if vals:
            want[(k, e)] = statistics.median(vals)
    assert got.keys() == want.keys()
    for key, w in want.items():
        assert abs(got[key] - w) <= 1e-12 * max(1.0, abs(w)), key


def test_exact_median_equals_builtin(spark):
    df = spark.range(0, 20000).select((F.col("id") % 7).alias("g"),
                                      ((F.col("id") * 7919) % 1000 / 8.0).alias("v"), "id")
    a = {r.g: r.m for r in exact_median(ordered_rows(df, ["g"], "v", "id"), ["g"], "v", "m").collect()}
    b = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert a == b


def test_busy_lane_equals_plain_aggregate(spark):
    """Most contracts on one lane: the mart equals a plain grouped aggregate."""
    import datetime as dt

    from tests.test_mart_edges import charges, contracts, ports, rates
    rnd = random.Random(11)
    dps = [(i, rnd.randint(0, 9), rnd.randint(0, 3), rnd.randint(0, 3), rnd.randint(3, 9),
            1, 2 if i % 4 else 1) for i in range(300)]
    chs = [(i, rnd.choice(["USD", "EUR", "NOK"]), rnd.randint(1, 500)) for i in range(300)]
    dp, ch, rt, pt = contracts(spark, dps), charges(spark, chs), rates(spark), ports(spark)
    mart = M.daily_lane_equipment_prices(dp, ch, rt, pt, M.MartParams(load_date=dt.date(2024, 1, 1)))
    prices = M.contract_daily_price(M.contract_days(M.known_port_contracts(dp, pt), ch), rt)
    plain = prices.groupBy(*M.KEY).agg(F.median("total_usd_price"), F.avg("total_usd_price"),
                                       F.countDistinct("company_id"), F.countDistinct("supplier_id"))
    got = sorted((*(r[k] for k in M.KEY), r.median_price_usd, r.avg_price_usd, r.distinct_companies_count,
                  r.distinct_suppliers_count) for r in mart.collect())
    want = sorted((*r[:4], round(r[4], 2), round(r[5], 2), r[6], r[7]) for r in plain.collect())
    assert len(got) == len(want) > 0
    for a, b in zip(got, want):
        assert a[:4] == b[:4] and a[6:] == b[6:] and all(abs(x - y) < 0.0101 for x, y in zip(a[4:6], b[4:6]))

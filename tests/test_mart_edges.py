"""Golden edge rows for the mart (hand-made staged tables)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanecast import schemas
from lanecast.operators import mart as M

D0 = dt.date(2024, 1, 1)
TS = dt.datetime(2024, 1, 1, 0, 0)


def day(n):
    return D0 + dt.timedelta(days=n)


def ports(spark):
    rows = [(p, f"P{p}", "r", f"Port {p}", "C", "CC", "Region", D0) for p in (1, 2)]
    return spark.createDataFrame(rows, schemas.STG_PORTS)


def rates(spark, extra=()):
    rows = [(day(i), "USD", 1.0, D0) for i in range(10)]
    rows += [(day(i), "EUR", 0.5, D0) for i in range(10)]
    rows += list(extra)
    return spark.createDataFrame(rows, schemas.STG_EXCHANGE_RATES)


def contracts(spark, rows):
    """rows: (id, company, supplier, from_day, to_day[, origin, dest])"""
    out = []
    for r in rows:
        i, c, s, a, b = r[:5]
        o, d = (r[5], r[6]) if len(r) > 5 else (1, 2)
        out.append((i, TS + dt.timedelta(hours=i), o, d, day(a), day(b), c, s, 1, D0))
    return spark.createDataFrame(out, schemas.STG_DATAPOINTS)


def charges(spark, rows):
    return spark.createDataFrame([(i, cur, v, D0) for i, cur, v in rows], schemas.STG_CHARGES)


def build(spark, dps, chs, extra_rates=(), **kw):
    return M.daily_lane_equipment_prices(contracts(spark, dps), charges(spark, chs),
                                         rates(spark, extra_rates), ports(spark),
                                         M.MartParams(load_date=D0, **kw))


def test_single_day_interval(spark):
    out = build(spark, [(1, 10, 20, 3, 3)], [(1, "USD", 100)]).collect()
    assert [(r.valid_day, r.avg_price_usd) for r in out] == [(day(3), 100.0)]


def test_reversed_interval_dropped(spark):
    assert build(spark, [(1, 10, 20, 5, 3)], [(1, "USD", 100)]).count() == 0


def test_even_median_and_avg(spark):
    dps = [(i, i, i, 0, 0) for i in range(1, 5)]
    chs = [(1, "USD", 1), (2, "USD", 2), (3, "USD", 4), (4, "USD", 10)]
    r = build(spark, dps, chs).collect()[0]
    assert (r.median_price_usd, r.avg_price_usd) == (3.0, 4.25)
    assert (r.distinct_companies_count, r.distinct_suppliers_count) == (4, 4)


@pytest.mark.parametrize("companies,suppliers,ok", [(5, 2, True), (4, 2, False), (5, 1, False)])
def test_coverage_rule(spark, companies, suppliers, ok):
    dps = [(i, i % companies, i % suppliers, 0, 0) for i in range(10)]
    chs = [(i, "USD", 5) for i in range(10)]
    r = build(spark, dps, chs).collect()[0]
    assert r.distinct_companies_count == companies and r.distinct_suppliers_count == suppliers
    assert r.dq_ok is ok


def test_eur_conversion(spark):
    r = build(spark, [(1, 1, 1, 0, 0)], [(1, "EUR", 100)]).collect()[0]
    assert r.avg_price_usd == 200.0


def test_partial_conversion_keeps_convertible_part(spark):
    # NOK has no rate: the contract-day is priced from USD alone (under-priced)
    r = build(spark, [(1, 1, 1, 0, 0)], [(1, "USD", 100), (1, "NOK", 800)]).collect()[0]
    assert r.avg_price_usd == 100.0


def test_all_unconvertible_absent(spark):
    assert build(spark, [(1, 1, 1, 0, 0)], [(1, "NOK", 800), (1, "", 5)]).count() == 0


def test_zero_rate_is_unconvertible(spark):
    zero = [(day(0), "GBP", 0.0, D0)]
    r = build(spark, [(1, 1, 1, 0, 0)], [(1, "USD", 7), (1, "GBP", 9)], extra_rates=zero).collect()[0]
    assert r.avg_price_usd == 7.0


def test_unknown_port_dropped(spark):
    out = build(spark, [(1, 1, 1, 0, 0, 1, 99), (2, 1, 1, 0, 0, 1, 2)],
                [(1, "USD", 1), (2, "USD", 2)]).collect()
    assert [r.avg_price_usd for r in out] == [2.0]


def test_contract_without_charges_vanishes(spark):
    assert build(spark, [(1, 1, 1, 0, 2)], [(2, "USD", 1)]).count() == 0


def test_multiple_lines_same_currency_summed(spark):
    r = build(spark, [(1, 1, 1, 0, 0)], [(1, "EUR", 10), (1, "EUR", 15), (1, "USD", 1)]).collect()[0]
    assert r.avg_price_usd == 51.0


def test_rounding_half_like_oracle(spark):
    import random

    import duckdb

    from lanecast.functions.compat import duck_round
    rnd = random.Random(7)
    xs = [0.00499999999999999, 45035996273704.97, 9.3e16, 1e308, float("inf"), 1.005, 2.675, -1.005, 0.125, 0.285, 1.115, 1234567.125, 0.0, -0.5]
    xs += [round(rnd.uniform(-1e6, 1e6), 3) for _ in range(2000)]
    xs += [rnd.randint(0, 10**6) / 200 for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    got = [r[0] for r in df.select(duck_round("x")).collect()]
    want = [r[0] for r in duckdb.sql(
        "SELECT round(x, 2) FROM (SELECT unnest($xs) AS x, generate_subscripts($xs, 1) AS i) ORDER BY i",
        params={"xs": xs}).fetchall()]
    assert got[:-1] == want and got[-1] is None


def test_window_clips_days(spark):
    out = M.daily_lane_equipment_prices(
        contracts(spark, [(1, 1, 1, 0, 9)]), charges(spark, [(1, "USD", 3)]), rates(spark),
        ports(spark), M.MartParams(load_date=D0),
        window=(F.lit(day(2)), F.lit(day(4))))
    assert sorted(r.valid_day for r in out.collect()) == [day(2), day(3), day(4)]


def test_null_window_selects_nothing(spark):
    null = F.lit(None).cast("date")
    out = M.daily_lane_equipment_prices(
        contracts(spark, [(1, 1, 1, 0, 9)]), charges(spark, [(1, "USD", 3)]), rates(spark),
        ports(spark), M.MartParams(load_date=D0), window=(null, null))
    assert out.count() == 0


def test_lane_label_skips_null(spark):
    from lanecast.functions.compat import lane_label
    df = spark.createDataFrame([("A", None), ("A", "B")], "origin_port_name string, destination_port_name string")
    assert [r[0] for r in df.select(lane_label()).collect()] == ["A to ", "A to B"]


def test_hot_lane_in_chunks_equals_whole_groups(spark):
    """A lane cut into chunks (ties, days of one row, a NULL equipment) gives
    the rows of whole groups and of plain Python."""
    import random
    import statistics
    rnd = random.Random(11)
    dps = [(i, rnd.randrange(40), rnd.randrange(9), 0, rnd.randrange(10)) for i in range(1, 400)]
    dps += [(1000 + i, i, i, i, i) for i in range(10)]
    chs = [(d[0], "USD", rnd.choice([1, 2, 3, 500, rnd.randrange(1, 10**6)])) for d in dps]
    rows = contracts(spark, dps)
    rows = rows.unionByName(rows.filter("datapoint_id <= 150").withColumns(
        {"datapoint_id": F.col("datapoint_id") + 5000, "equipment_id": F.lit(None).cast("bigint")}))
    chs += [(i + 5000, c, v) for i, c, v in chs if i <= 150]
    made = [M.daily_lane_equipment_prices(rows, charges(spark, chs), rates(spark), ports(spark),
                                          M.MartParams(load_date=D0, chunk_rows=n)).collect() for n in (50_000, 7)]
    assert sorted(map(str, made[0])) == sorted(map(str, made[1])) and len(made[0]) == 20
    value = dict((i, v) for i, _, v in chs)
    for r in made[1]:
        if r.equipment_id is None:
            continue
        on = [d for d in dps if day(d[3]) <= r.valid_day <= day(d[4])]
        assert r.median_price_usd == statistics.median(value[d[0]] for d in on)
        assert r.distinct_companies_count == len({d[1] for d in on}) and r.distinct_suppliers_count == len({d[2] for d in on})
        assert abs(r.avg_price_usd - sum(value[d[0]] for d in on) / len(on)) < 0.006
        assert r.created == TS + dt.timedelta(hours=max(d[0] for d in on))


def test_only_busy_lanes_have_chunks(spark):
    dps = [(i, 1, 1, 0, 0) for i in range(20)] + [(100, 1, 1, 0, 9, 2, 1)]
    got = M.chunked(M.clipped(contracts(spark, dps)), 5).collect()
    assert {(r.origin_port_id, r.chunks) for r in got} == {(1, 4), (2, 1)}
    assert {r.chunk for r in got if r.origin_port_id == 1} <= set(range(4)) and all(r.chunk == 0 for r in got if r.origin_port_id == 2)

"""The raw tables derived from the driver tables keep every contract-day."""

import datetime as dt

from lanecast.plans import oracle
from lanecast.sources import fixtures as fx


def test_validity_has_no_last_day(spark, duck, tmp_path):
    """Contracts near the end of the orders are valid to their own last day, in
    the code and in the oracle, also beyond 2001-08-10."""
    day = dt.datetime(2001, 8, 1)
    rows = [(k, k, day) for k in (7, 8, 50, 107)] + [(9, 9, dt.datetime(2030, 1, 1))]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.d_id: r.valid_to for r in fx.raw_datapoints(spark, str(tmp_path)).collect()}
    assert got == {k: (d + dt.timedelta(days=-1 if k % 50 == 0 else k * 7 % 60)).date() for k, _, d in rows}
    assert max(got.values()) == dt.date(2030, 1, 4)
    base = oracle.FIXTURE_CTES.split("base_dp AS (")[1].split("\n),\nraw_datapoints")[0]
    con = duck("/root/testdata/sf0.001").cursor()
    con.execute(f"CREATE TEMP VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    assert dict(con.sql(f"SELECT d_id, valid_to FROM ({base}) x").fetchall()) == got

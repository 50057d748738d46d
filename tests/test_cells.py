"""Contract-days are made inside cells of a lane and a block of days, in as many
partitions as the contracts ask for."""

import random

from pyspark.sql import functions as F

from lanecast.operators import mart as M
from lanecast.session import size_shuffles
from tests.test_mart_edges import charges, contracts, day, rates


def _rows(df):
    return sorted(map(str, df.select("datapoint_id", "valid_day", "currency", "charge_total", *M.LANE).collect()))


def _tables(spark):
    rnd = random.Random(3)
    dps = [(i, rnd.randrange(9), rnd.randrange(4), a := rnd.randrange(10), a + rnd.randrange(40)) for i in range(200)]
    rows = contracts(spark, dps)
    rows = rows.unionByName(rows.filter("datapoint_id < 9"))  # repeated contracts stay repeated
    rows = rows.unionByName(rows.filter("datapoint_id = 50").withColumn("equipment_id", F.lit(None).cast("bigint")))
    return rows, charges(spark, [(i, c, i + 1) for i in range(200) for c in ("USD", "EUR")])


def test_cells_hold_the_days_of_the_contracts(spark):
    dp, ch = _tables(spark)
    for window in (None, (F.lit(day(7)), F.lit(day(23)))):
        cells = M.cell_days(dp, ch, window, 3)
        assert _rows(cells) == _rows(M.contract_days(dp, ch, window))
        at = cells.withColumn("p", F.spark_partition_id()).groupBy(*M.KEY, "chunk").agg(F.countDistinct("p").alias("n"))
        assert at.filter("n > 1").count() == 0


def test_partitions_follow_the_contracts(spark, monkeypatch, tmp_path):
    dp, ch = _tables(spark)
    monkeypatch.setattr(M, "CELL_ROWS", 5)
    monkeypatch.setattr(M, "TASK_CONTRACTS", 4)
    cells = M.cell_days(dp, ch)
    assert cells.rdd.getNumPartitions() >= 100
    rates(spark).write.parquet(f"{tmp_path}/rates")  # small and stored, as in staging: broadcast
    plan = M.lane_states(M.contract_daily_price(cells, spark.read.parquet(f"{tmp_path}/rates")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan.split("Generate explode")[0]
    assert M.contract_days(dp, ch).rdd.getNumPartitions() >= 50


def test_shuffle_partitions_follow_the_input(spark, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    (tmp_path / "orders.parquet").write_bytes(b"0" * 3_000_000)
    (tmp_path / "part.parquet").write_bytes(b"0" * 9_000_000)
    before = {k: spark.conf.get(k, None) for k in (key, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        size_shuffles(spark, str(tmp_path), ("orders", "lineitem"), part_bytes=100_000)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1m"  # a smaller one stays
        assert int(spark.conf.get(key)) == 30
        size_shuffles(spark, str(tmp_path), ("orders", "lineitem"))
        assert int(spark.conf.get(key)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

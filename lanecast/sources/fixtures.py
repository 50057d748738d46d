"""The five raw input tables, derived by Spark from the driver's Parquet
tables (region, nation, orders, lineitem).

The derivation is the one written down in FIXTURES.md; the oracle SQL in
``lanecast.plans.oracle`` builds the same rows in DuckDB.  Only column
pruning and filters reach the Parquet scans, so each raw table reads just
the columns it needs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecast.functions.compat import as_date

# Fixed values of the fixture: load dates of the full build and of the two
# batches, the created-timestamp cut between batch 1 and batch 2, the
# currencies with their base rates, and the longest validity offset.
FULL_LOAD_DATE = "2025-09-05"
BATCH1_LOAD_DATE = "2025-09-05"
BATCH2_LOAD_DATE = "2025-09-06"
BATCH_CUT = "2000-01-01 00:00:00"
CURRENCY_BASE_RATES = [("USD", 1.0), ("EUR", 0.5), ("NOK", 8.0)]
MAX_VALIDITY_DAYS = 59


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _audit(df: DataFrame, file_path: str, load_type: str, load_date) -> DataFrame:
    # the source stamps its input glob; here the driver table's file name
    file_path = file_path.rsplit("/", 1)[-1]
    return (df.withColumn("file_path", F.lit(file_path))
              .withColumn("load_type", F.lit(load_type))
              .withColumn("load_date", as_date(load_date)))


def raw_regions(spark, sf_dir, load_date=FULL_LOAD_DATE) -> DataFrame:
    r = read_table(spark, sf_dir, "region")
    df = r.select(
        F.concat(F.lit("Region_"), F.col("r_regionkey").cast("string")).alias("slug"),
        F.col("r_name").alias("name"),
        F.when(F.col("r_regionkey") > 0, F.lit("region_0")).alias("parent"),
    )
    return _audit(df, f"{sf_dir}/region.parquet", "full_load", load_date)


def raw_ports(spark, sf_dir, load_date=FULL_LOAD_DATE) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")

    def ports(rows):
        return rows.select(
            F.col("n_nationkey").cast("bigint").alias("pid"),
            F.lower("n_name").alias("code"),
            F.concat(F.lit("region_"), F.col("n_regionkey").cast("string")).alias("slug"),
            F.col("n_name").alias("name"),
            F.col("n_name").alias("country"),
            F.concat(F.lit("c"), F.col("n_regionkey").cast("string")).alias("country_code"),
        )

    # every port, two of them delivered twice
    df = ports(n).unionByName(ports(n.filter(F.col("n_nationkey").isin(2, 7))))
    return _audit(df, f"{sf_dir}/nation.parquet", "full_load", load_date)


def _base_datapoints(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    base = o.select(
        k.alias("d_id"),
        F.col("o_orderdate").cast("timestamp").alias("created"),
        # a few busy lanes hold most contracts, the rest spread over all ports
        F.when(F.col("o_custkey") % 4 == 0, F.col("o_custkey") % 13).otherwise(F.col("o_custkey") % 3)
         .cast("bigint").alias("origin_pid"),
        F.when(k % 97 == 0, F.lit(99)).when(k % 4 == 1, k % 12 + 13).otherwise(k % 2 + 13)
         .cast("bigint").alias("destination_pid"),
        day.alias("valid_from"),
        F.date_add(day, F.when(k % 50 == 0, F.lit(-1)).otherwise((k * 7) % 60).cast("int"))
         .alias("valid_to"),
        F.col("o_custkey").alias("company_id"),
        (k % 4).cast("bigint").alias("supplier_id"),
        F.when(k % 5 == 0, 1 + F.floor(k / 5) % 6).otherwise(1 + k % 2).cast("bigint").alias("equipment_id"),
    )
    # re-sent versions: one day newer, another supplier, same lane and validity
    resent = (base.filter(F.col("d_id") % 10 == 3)
                  .withColumn("created", F.col("created") + F.expr("INTERVAL 1 DAY"))
                  .withColumn("supplier_id", F.col("supplier_id") + 4))
    return base.unionByName(resent)


def raw_datapoints(spark, sf_dir, load_date=FULL_LOAD_DATE) -> DataFrame:
    return _audit(_base_datapoints(spark, sf_dir), f"{sf_dir}/orders.parquet",
                  "full_load", load_date)


def _base_charges(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    currency = (F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
                 .when((F.col("l_linenumber") == 6) & (F.col("l_quantity") < 5), F.lit(""))
                 .when(F.col("l_returnflag") == "A", F.lit("USD"))
                 .when(F.col("l_returnflag") == "N", F.lit(" EUR "))
                 .otherwise(F.lit("NOK")))
    return li.select(
        F.col("l_orderkey").alias("d_id"),
        currency.alias("currency"),
        F.floor("l_extendedprice").cast("double").alias("charge_value"),
    )


def raw_charges(spark, sf_dir, load_date=FULL_LOAD_DATE) -> DataFrame:
    return _audit(_base_charges(spark, sf_dir), f"{sf_dir}/lineitem.parquet",
                  "full_load", load_date)


def calendar(spark, sf_dir) -> DataFrame:
    """Every day from the first order day to the last possible valid_to."""
    o = read_table(spark, sf_dir, "orders")
    bounds = o.agg(F.min(F.col("o_orderdate").cast("date")).alias("lo"),
                   F.max(F.col("o_orderdate").cast("date")).alias("hi"))
    return bounds.select(F.explode(F.sequence(
        "lo", F.date_add("hi", MAX_VALIDITY_DAYS), F.expr("INTERVAL 1 DAY"))).alias("day"))


def raw_exchange_rates(spark, sf_dir, load_date=FULL_LOAD_DATE) -> DataFrame:
    dom = F.dayofmonth("day")
    rate = (F.when((F.col("currency") == "NOK") & (dom == 13), F.lit(0.0))
             .otherwise(F.col("base"))
            * F.when((F.col("currency") != "USD") & (dom % 2 == 0), F.lit(2.0)).otherwise(F.lit(1.0)))
    # every calendar day gets one row per currency: explode a literal array
    currencies = F.array(*[F.struct(F.lit(c).alias("currency"), F.lit(b).alias("base"))
                           for c, b in CURRENCY_BASE_RATES])
    df = (calendar(spark, sf_dir).select("day", F.explode(currencies).alias("_c"))
          .select("day", "_c.currency", "_c.base")
          .filter(~((F.col("currency") == "EUR") & (dom == 29)))
          .select("day", "currency", rate.cast("double").alias("rate")))
    return _audit(df, f"{sf_dir}/orders.parquet#calendar", "full_load", load_date)


@dataclass(frozen=True)
class RawTables:
    ports: DataFrame
    regions: DataFrame
    exchange_rates: DataFrame
    datapoints: DataFrame
    charges: DataFrame


def full_load(spark, sf_dir, load_date=FULL_LOAD_DATE) -> RawTables:
    """All five raw tables as one full load."""
    return RawTables(
        ports=raw_ports(spark, sf_dir, load_date),
        regions=raw_regions(spark, sf_dir, load_date),
        exchange_rates=raw_exchange_rates(spark, sf_dir, load_date),
        datapoints=raw_datapoints(spark, sf_dir, load_date),
        charges=raw_charges(spark, sf_dir, load_date),
    )


def batches(spark, sf_dir, cut: str = BATCH_CUT,
            dates=(BATCH1_LOAD_DATE, BATCH2_LOAD_DATE)) -> tuple[RawTables, RawTables]:
    """Two delivery batches: contracts created before ``cut`` with their
    charges, then the rest with charges only for contracts new in batch 2.
    Rates, ports and regions are delivered whole with both."""
    cut_ts = F.lit(cut).cast("timestamp")
    dps = _base_datapoints(spark, sf_dir)
    ch = _base_charges(spark, sf_dir)
    d1 = dps.filter(F.col("created") < cut_ts)
    d2 = dps.filter(F.col("created") >= cut_ts)
    ids1 = d1.select("d_id").distinct()
    ids2_new = d2.select("d_id").distinct().join(ids1, "d_id", "left_anti")
    c1 = ch.join(ids1, "d_id", "left_semi")
    c2 = ch.join(ids2_new, "d_id", "left_semi")
    out = []
    for d, c, ld, tag in ((d1, c1, dates[0], "full_load"), (d2, c2, dates[1], "incremental")):
        out.append(RawTables(
            ports=raw_ports(spark, sf_dir, ld),
            regions=raw_regions(spark, sf_dir, ld),
            exchange_rates=raw_exchange_rates(spark, sf_dir, ld),
            datapoints=_audit(d, f"{sf_dir}/orders.parquet", tag, ld),
            charges=_audit(c, f"{sf_dir}/lineitem.parquet", tag, ld),
        ))
    return out[0], out[1]

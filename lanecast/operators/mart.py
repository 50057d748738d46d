"""Final layer: daily price per (day, equipment, origin port, destination port).

Plan shape:

1. Charges are summed per (contract, currency) *before* the day expansion
   (sum(v)/rate for one rate; equal to the per-line sum up to the last bit, none
   after rounding to cents), so charge lines never get multiplied by days.
   An incremental run first reduces charges to the contracts of its window.
2. Contracts whose origin or destination port is unknown are dropped before
   the expansion (semi joins with the ports).
3. The validity interval is clipped to the recompute window and only then
   exploded into days; the window also reaches the contract scan.
4. A sort-merge join brings charges to contracts, both dealt out by contract over
   as many partitions as the number of contracts asks for.
5. For the mart these rows, not their days, are shuffled once more: to cells of a
   lane and a block of `BLOCK_DAYS` days, again over as many partitions as they
   need.  Days are made inside a cell, which holds whole contract-days and whole
   groups, so the contract-day aggregate and the one that takes all measures of a
   group from its rows add no shuffle: no distinct expansion, no second read.
   Memory of a task follows from `CELL_ROWS`, not from the size of the tables.
6. A lane whose groups could be too large for one task is cut into chunks by
   the hash of the contract; how many follows from its contracts per block, which
   are counted before the expansion.  Groups of one chunk are finished by that
   aggregate.  The chunks of larger ones are merged from their states: counts
   and sums add up, ids are counted over the chunks, the median is picked from
   the chunks' prices by rank, in an order that range partitions cut anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecast import schemas
from lanecast.functions.compat import as_date, dq_ok, duck_round, lane_label, safe_day_series
from lanecast.operators.median import exact_median, ordered_rows
from lanecast.session import scratch_path

LANE = ["equipment_id", "origin_port_id", "destination_port_id"]
KEY = schemas.MART_KEY
CHUNK = ["chunks", "chunk"]
BLOCK_DAYS = 10           # days of a cell
TASK_CONTRACTS = 20_000   # contracts a task joins with their charges (and may expand into days), about
CELL_ROWS = 50_000        # contracts in blocks a task expands and aggregates, about


@dataclass(frozen=True)
class MartParams:
    load_date: object = None          # stamped as load_date (source: current_date)
    min_companies: int = 5
    min_suppliers: int = 2
    chunk_rows: int = 200_000         # contracts of a group that one task aggregates, about


def charges_by_currency(charges: DataFrame) -> DataFrame:
    """(datapoint_id, currency, charge_total): charge lines pre-summed."""
    return (charges.groupBy("datapoint_id", "currency")
                   .agg(F.sum("charge_value").alias("charge_total")))


def known_port_contracts(datapoints: DataFrame, ports: DataFrame) -> DataFrame:
    """Valid contracts whose both ports exist (inner-join semantics)."""
    p = ports.select("port_id")  # semi join: duplicates on this side are harmless
    dp = datapoints.filter(F.col("valid_from") <= F.col("valid_to"))
    dp = dp.join(p.withColumnRenamed("port_id", "origin_port_id"), "origin_port_id", "left_semi")
    return dp.join(p.withColumnRenamed("port_id", "destination_port_id"), "destination_port_id",
                   "left_semi")


def clipped(datapoints: DataFrame, window=None) -> DataFrame:
    """Contracts with their days of validity, _lo to _hi, clipped to ``window``
    = (lo, hi) Columns if given; a NULL window selects nothing."""
    lo, hi = F.col("valid_from"), F.col("valid_to")
    if window is not None:
        # plain comparisons that reach the scan
        datapoints = datapoints.filter((lo <= window[1]) & (hi >= window[0]))
        lo, hi = F.greatest(lo, window[0]), F.least(hi, window[1])
    return datapoints.withColumn("_lo", lo).withColumn("_hi", hi).filter(F.col("_lo") <= F.col("_hi"))


def partitions(df: DataFrame, rows: int, per_task: int) -> int:
    """Partitions for so many rows; small tables use all cores."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task))


def block_of(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BLOCK_DAYS).cast("int")


def block_counts(contracts: DataFrame) -> DataFrame:
    """(lane, _block, _n): the ``clipped`` contracts that touch each block of days."""
    blocks = F.sequence(block_of(F.col("_lo")), block_of(F.col("_hi")))
    return contracts.select(*LANE, F.explode(blocks).alias("_block")).groupBy(*LANE, "_block").agg(F.count(F.lit(1)).alias("_n"))


def chunked(contracts: DataFrame, chunk_rows: int, counts: DataFrame | None = None) -> DataFrame:
    """``clipped`` contracts with the number of chunks of their lane and the
    chunk they are in.  A group (lane and day) has at most the contracts that
    touch its block; only lanes above ``chunk_rows`` are joined back."""
    counts = block_counts(contracts) if counts is None else counts
    busy = (counts.groupBy(*LANE).agg(F.max("_n").alias("_n")).filter(F.col("_n") > chunk_rows)
            .select(*[F.col(c).alias(f"_{c}") for c in LANE], F.ceil(F.col("_n") / chunk_rows).alias("_chunks")))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LANE])
    chunks = F.coalesce("_chunks", F.lit(1))
    return (contracts.join(busy, same, "left").withColumn("chunks", chunks)
            .withColumn("chunk", F.pmod(F.xxhash64("datapoint_id"), chunks))
            .drop("_chunks", *[f"_{c}" for c in LANE]))


def with_charges(contracts: DataFrame, charges: DataFrame, n: int, extra: list[str], windowed: bool) -> DataFrame:
    """(contract attrs, _lo, _hi, currency, charge_total) of ``clipped`` contracts,
    in n partitions by contract."""
    contracts, charges = contracts.repartition(n, "datapoint_id"), charges.repartition(n, "datapoint_id")
    if windowed:
        charges = charges.join(contracts.select("datapoint_id"), "datapoint_id", "left_semi")
    cols = ["datapoint_id", "created", "company_id", "supplier_id", *LANE, *extra, "_lo", "_hi"]
    # sort-merge on the contract id: it can spill, and its output stays
    # partitioned by datapoint_id, which lets the explode and the contract-day
    # aggregate run without shuffling the exploded rows
    return contracts.select(*cols).hint("merge").join(charges_by_currency(charges), "datapoint_id")


def contract_days(datapoints: DataFrame, charges: DataFrame, window=None, chunk_rows: int | None = None) -> DataFrame:
    """(contract attrs, currency, charge_total, valid_day) for each day of the
    contract's validity, clipped to ``window``; with ``chunk_rows`` also the
    columns of ``chunked``.  The contracts are counted when this is called."""
    dp = clipped(datapoints, window)
    n, extra = partitions(dp, dp.count(), TASK_CONTRACTS), []
    if chunk_rows is not None:
        dp, extra = chunked(dp, chunk_rows), CHUNK
    joined = with_charges(dp, charges, n, extra, window is not None)
    return joined.withColumn("valid_day", F.explode(safe_day_series("_lo", "_hi"))).drop("_lo", "_hi")


def cell_days(datapoints: DataFrame, charges: DataFrame, window=None, chunk_rows: int = MartParams.chunk_rows) -> DataFrame:
    """The rows of ``contract_days`` with the columns of ``chunked`` and their
    block, in partitions by (lane, block, chunk): contracts are shuffled by
    block and expanded there.  Contracts by block are counted when this is called."""
    dp = clipped(datapoints, window)
    path = scratch_path(dp.sparkSession, "blocks")
    block_counts(dp).write.parquet(path)
    counts = dp.sparkSession.read.parquet(path)
    rows = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    joined = with_charges(chunked(dp, chunk_rows, counts), charges, partitions(dp, rows, CELL_ROWS), CHUNK, window is not None)
    blocks = F.sequence(block_of(F.col("_lo")), block_of(F.col("_hi")))
    dealt = joined.withColumn("block", F.explode(blocks)).repartition(partitions(dp, rows, CELL_ROWS), *LANE, "block", "chunk")
    first = F.date_from_unix_date(F.col("block") * BLOCK_DAYS)
    days = safe_day_series(F.greatest("_lo", first), F.least("_hi", F.date_add(first, BLOCK_DAYS - 1)))
    return dealt.withColumn("valid_day", F.explode(days)).drop("_lo", "_hi")


def validity_expand(datapoints: DataFrame) -> DataFrame:
    """J6 / F9 on its own: one row per valid contract and day of validity."""
    cols = ["datapoint_id", "created", "company_id", "supplier_id", *LANE]
    return (datapoints.filter(F.col("valid_from") <= F.col("valid_to"))
                      .select(*cols, F.explode(safe_day_series("valid_from", "valid_to")).alias("valid_day")))


def contract_daily_price(days: DataFrame, rates: DataFrame) -> DataFrame:
    """Total USD price per contract and day; charges without a usable rate
    (missing or zero) are left out of the total, and a contract-day with no
    convertible charge at all is absent."""
    r = (rates.select(F.col("exchange_date").alias("valid_day"), "currency", "rate")
         .filter(F.col("rate") != 0))
    priced = (days.join(r, ["valid_day", "currency"])
                  .withColumn("charge_value_usd", F.col("charge_total").cast("double") / F.col("rate"))
                  .filter(F.col("charge_value_usd").isNotNull()))
    extra = [c for c in [*CHUNK, "block"] if c in days.columns]
    return (priced.groupBy("datapoint_id", "valid_day", "company_id", "supplier_id", *LANE, *extra)
                  .agg(F.max("created").alias("created"),
                       F.sum("charge_value_usd").alias("total_usd_price")))


def lane_states(prices: DataFrame) -> DataFrame:
    """One row per mart key and chunk of ``contract_daily_price`` rows: rows,
    total, created, and of a whole group (one chunk) the numbers of companies
    and suppliers and the median, of a part the ids and the sorted prices.
    Rows of ``cell_days`` lie with their group already."""
    whole, n, sorted_prices = F.col("chunks") == 1, F.col("rows"), F.col("prices")
    block = [c for c in prices.columns if c == "block"]
    states = ((prices if block else prices.repartition(*KEY, "chunk")).groupBy(*KEY, *CHUNK, *block).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_usd_price").alias("total"), F.max("created").alias("created"),
        F.collect_set("company_id").alias("company_ids"), F.collect_set("supplier_id").alias("supplier_ids"),
        F.sort_array(F.collect_list("total_usd_price")).alias("prices")))
    at = lambda i: F.get(sorted_prices, i.cast("int"))
    median = at(F.floor((n - 1) / 2)) * 0.5 + at(F.floor(n / 2)) * 0.5  # the interpolation of percentile(0.5)
    return states.select(
        *KEY, *CHUNK, "rows", "total", "created",
        F.when(whole, F.size("company_ids")).alias("companies"), F.when(whole, F.size("supplier_ids")).alias("suppliers"),
        F.when(whole, median).alias("median_price_usd"),
        *[F.when(~whole, F.col(c)).alias(c) for c in ("company_ids", "supplier_ids", "prices")])


def merged_parts(parts: DataFrame) -> DataFrame:
    """One row per mart key from the stored states of groups of several chunks."""
    def distinct(ids: str, out: str) -> DataFrame:
        return parts.select(*KEY, F.explode(ids).alias("_id")).distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias(out))

    def with_(left: DataFrame, right: DataFrame) -> DataFrame:  # equipment may be NULL
        right = right.withColumnsRenamed({c: f"_{c}" for c in KEY})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY])
        return left.join(right, same, "left").drop(*[f"_{c}" for c in KEY])

    sums = parts.groupBy(*KEY).agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.max("created").alias("created"))
    rows = ordered_rows(parts.select(*KEY, "chunk", F.posexplode("prices").alias("_pos", "_price")), KEY, "_price", ["chunk", "_pos"])
    out = with_(sums, exact_median(rows, KEY, "_price", "median_price_usd"))
    for ids, name in (("company_ids", "companies"), ("supplier_ids", "suppliers")):
        out = with_(out, distinct(ids, name)).withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def lane_aggregate(prices: DataFrame) -> DataFrame:
    """One row per mart key.  The states are stored (about one row per group):
    the chunks of large groups are read several times."""
    path = scratch_path(prices.sparkSession, "states")
    lane_states(prices).write.parquet(path)
    states = prices.sparkSession.read.parquet(path)
    cols = [*KEY, "rows", "total", "created", "companies", "suppliers", "median_price_usd"]
    out = states.filter("chunks = 1").select(*cols)
    parts = states.filter("chunks > 1")
    if not parts.isEmpty():
        out = out.unionByName(merged_parts(parts).select(*cols))
    return out.select(*KEY, (F.col("total") / F.col("rows")).alias("avg_price_usd"),
                      F.col("companies").cast("bigint").alias("distinct_companies_count"),
                      F.col("suppliers").cast("bigint").alias("distinct_suppliers_count"), "created", "median_price_usd")


def enrich_and_finish(agg: DataFrame, ports: DataFrame, params: MartParams) -> DataFrame:
    """Port names/regions for both ends (role-playing dimension), rounding, coverage flag and load date;
    columns in mart order."""
    side = ports.select("port_id", F.col("code").alias("port_code"),
                        F.col("name").alias("port_name"), "region_name", "country_code")
    o = side.select(*[F.col(c).alias(f"origin_{c}") for c in schemas.PORT_SIDE])
    d = side.select(*[F.col(c).alias(f"destination_{c}") for c in schemas.PORT_SIDE])
    out = (agg.join(o, "origin_port_id").join(d, "destination_port_id")
              .withColumn("port_lane", lane_label())
              .withColumn("avg_price_usd", duck_round("avg_price_usd"))
              .withColumn("median_price_usd", duck_round("median_price_usd"))
              .withColumn("dq_ok", dq_ok(min_companies=params.min_companies,
                                         min_suppliers=params.min_suppliers))
              .withColumn("load_date", as_date(params.load_date)))
    return out.select(*schemas.MART_COLUMNS)


def daily_lane_equipment_prices(datapoints: DataFrame, charges: DataFrame, rates: DataFrame,
                                ports: DataFrame, params: MartParams = MartParams(),
                                window=None) -> DataFrame:
    """The mart from staged tables.  ``window`` = (lo, hi) date Columns
    restricts the recomputed days (incremental run).  The states of the groups
    are computed and written to the shared folder when this is called
    (``session.scratch_scope`` drops them)."""
    dp = known_port_contracts(datapoints, ports)
    prices = contract_daily_price(cell_days(dp, charges, window, params.chunk_rows), rates)
    return enrich_and_finish(lane_aggregate(prices), ports, params)

"""Staging layer: rename, cast, clean, deduplicate (raw -> staging).

Each function is DataFrame in -> DataFrame out and returns exactly the
staging contract of ``lanecast.schemas`` (checked by ``enforce_contract``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecast import schemas
from lanecast.functions.compat import as_date

AUDIT_DROP = ["load_date"]  # columns removed before staging's whole-row DISTINCT


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Select the contract's columns in order and fail on a type mismatch."""
    got = {f.name: f.dataType for f in df.schema.fields}
    bad = [(f.name, got.get(f.name), f.dataType) for f in contract.fields
           if got.get(f.name) != f.dataType]
    if bad:
        raise TypeError(f"schema contract violated: {bad}")
    return df.select([f.name for f in contract.fields])


def stg_regions(raw: DataFrame, load_date) -> DataFrame:
    dedup = raw.drop(*AUDIT_DROP).distinct()
    out = dedup.select(F.lower("slug").alias("slug"), "name", "parent",
                       as_date(load_date).alias("load_date"))
    return enforce_contract(out, schemas.STG_REGIONS)


def stg_ports(raw: DataFrame, regions: DataFrame, load_date) -> DataFrame:
    """Distinct ports joined to their region by slug.  The port side keeps its
    raw slug (only the region side is lower-cased), so a mixed-case port slug
    finds no region and the port is dropped, as in the source model."""
    dedup = raw.drop(*AUDIT_DROP).distinct().alias("p")
    r = regions.select("slug", F.col("name").alias("region_name")).alias("r")
    out = dedup.join(r, F.col("p.slug") == F.col("r.slug"), "inner").select(
        F.col("p.pid").alias("port_id"),
        F.upper("p.code").alias("code"),
        F.lower("p.slug").alias("slug"),
        F.col("p.name").alias("name"),
        F.col("p.country").alias("country"),
        F.upper("p.country_code").alias("country_code"),
        F.col("r.region_name").alias("region_name"),
        as_date(load_date).alias("load_date"),
    )
    return enforce_contract(out, schemas.STG_PORTS)


def stg_exchange_rates(raw: DataFrame, load_date) -> DataFrame:
    """One rate per (day, currency).  The source picks an arbitrary row among
    duplicates; this picks the smallest non-NULL rate, which is deterministic
    and a plain hash aggregate (partial aggregation, no sort)."""
    out = (raw.groupBy(F.col("day").cast("date").alias("exchange_date"), "currency")
              .agg(F.min(F.col("rate").cast("double")).alias("rate"))
              .withColumn("load_date", as_date(load_date)))
    return enforce_contract(out, schemas.STG_EXCHANGE_RATES)


def latest_per_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """Keep the row with the greatest ``order_cols`` per ``key``; ties are
    broken by the remaining columns, so a retried task picks the same row.
    A (sort) aggregate with map-side partial aggregation: a key re-sent
    millions of times is collapsed before the shuffle."""
    others = [c for c in df.columns if c != key and c not in order_cols]
    return (df.groupBy(key).agg(F.max(F.struct(*order_cols, *others)).alias("_row"))
              .select(key, *[F.col("_row")[c].alias(c) for c in df.columns if c != key]))


def stg_datapoints(raw: DataFrame, load_date) -> DataFrame:
    """Newest version per contract (created desc, load_date desc), renamed
    and cast; contracts whose newest version has valid_from > valid_to are
    dropped (the older version is not used instead)."""
    latest = latest_per_key(raw, "d_id", ["created", "load_date"])
    out = latest.select(
        F.col("d_id").alias("datapoint_id"),
        F.col("created").cast("timestamp_ntz").alias("created"),
        F.col("origin_pid").alias("origin_port_id"),
        F.col("destination_pid").alias("destination_port_id"),
        F.col("valid_from").cast("date").alias("valid_from"),
        F.col("valid_to").cast("date").alias("valid_to"),
        "company_id", "supplier_id", "equipment_id",
        as_date(load_date).alias("load_date"),
    ).filter(F.col("valid_from") <= F.col("valid_to"))
    return enforce_contract(out, schemas.STG_DATAPOINTS)


def stg_charges(raw: DataFrame, load_date) -> DataFrame:
    """Trimmed currency; rows with a NULL currency are dropped.  The source
    predicate ``currency is not null or currency != ''`` keeps '' (it passes
    the first arm); such charges later find no rate."""
    out = raw.filter(F.col("currency").isNotNull()).select(
        F.col("d_id").alias("datapoint_id"),
        F.trim("currency").alias("currency"),
        F.bround(F.col("charge_value").cast("double"), 0).cast("bigint").alias("charge_value"),
        as_date(load_date).alias("load_date"),
    )
    return enforce_contract(out, schemas.STG_CHARGES)

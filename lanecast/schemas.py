"""Explicit schemas of every layer (no inference at scan time)."""

from __future__ import annotations

from pyspark.sql import types as T

L, S, D, DB, B = T.LongType(), T.StringType(), T.DateType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampNTZType()  # the oracle's TIMESTAMP has no zone


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- raw layer: source columns as delivered (CSV headers are upper case) ----
RAW_PORTS = _st(("pid", L), ("code", S), ("slug", S), ("name", S), ("country", S),
                ("country_code", S))
RAW_REGIONS = _st(("slug", S), ("name", S), ("parent", S))
RAW_EXCHANGE_RATES = _st(("day", D), ("currency", S), ("rate", DB))
RAW_DATAPOINTS = _st(("d_id", L), ("created", T.TimestampType()),  # delivered with a zone
                     ("origin_pid", L), ("destination_pid", L),
                     ("valid_from", D), ("valid_to", D), ("company_id", L),
                     ("supplier_id", L), ("equipment_id", L))
RAW_CHARGES = _st(("d_id", L), ("currency", S), ("charge_value", DB))  # cast to whole units in staging

AUDIT = _st(("file_path", S), ("load_type", S), ("load_date", D))

RAW = {
    "ports": RAW_PORTS,
    "regions": RAW_REGIONS,
    "exchange_rates": RAW_EXCHANGE_RATES,
    "datapoints": RAW_DATAPOINTS,
    "charges": RAW_CHARGES,
}


def with_audit(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + list(AUDIT.fields))


# ---- staging layer: enforced contracts ----
STG_REGIONS = _st(("slug", S), ("name", S), ("parent", S), ("load_date", D))
STG_PORTS = _st(("port_id", L), ("code", S), ("slug", S), ("name", S), ("country", S),
                ("country_code", S), ("region_name", S), ("load_date", D))
STG_EXCHANGE_RATES = _st(("exchange_date", D), ("currency", S), ("rate", DB), ("load_date", D))
STG_DATAPOINTS = _st(("datapoint_id", L), ("created", TS), ("origin_port_id", L),
                     ("destination_port_id", L), ("valid_from", D), ("valid_to", D),
                     ("company_id", L), ("supplier_id", L), ("equipment_id", L),
                     ("load_date", D))
STG_CHARGES = _st(("datapoint_id", L), ("currency", S), ("charge_value", L), ("load_date", D))

STAGING = {
    "regions": STG_REGIONS,
    "ports": STG_PORTS,
    "exchange_rates": STG_EXCHANGE_RATES,
    "datapoints": STG_DATAPOINTS,
    "charges": STG_CHARGES,
}

# ---- final layer ----
PORT_SIDE = ("port_id", "port_code", "port_name", "region_name", "country_code")

MART = _st(
    ("valid_day", D), ("equipment_id", L), ("port_lane", S),
    ("origin_port_id", L), ("origin_port_code", S), ("origin_port_name", S),
    ("origin_region_name", S), ("origin_country_code", S),
    ("destination_port_id", L), ("destination_port_code", S), ("destination_port_name", S),
    ("destination_region_name", S), ("destination_country_code", S),
    ("avg_price_usd", DB), ("median_price_usd", DB),
    ("distinct_companies_count", L), ("distinct_suppliers_count", L),
    ("dq_ok", B), ("created", TS), ("load_date", D),
)
MART_COLUMNS = [f.name for f in MART.fields]
MART_KEY = ["valid_day", "equipment_id", "origin_port_id", "destination_port_id"]

COVERAGE = _st(("snapshot_ts", TS), ("stage", S), ("covered_lane_count", L))

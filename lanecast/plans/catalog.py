"""Registry of every query key: the Spark callable and, where SQL can
express it, the DuckDB oracle text.

Report keys read the mart through ``pipeline.materialised_mart`` (built
once per application from the driver tables, stored month-partitioned);
the oracle rebuilds the mart from the same tables in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lanecast import schemas
from lanecast.plans import oracle as O
from lanecast.plans import pipeline as P
from lanecast.plans import reports as R
from lanecast.plans import rollups as RU
from lanecast.session import size_shuffles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

LANE = "concat(origin_port_name, ' to ', destination_port_name)"

# Report parameters for the fixture tables (port and region
# names of the fixture come from nation / region rows).
ONE_LANE = ("NATION_0", "NATION_13")
DEST_REGION = "EUROPE"
DEST_COUNTRY = "C3"
FACTS = ("orders", "lineitem")  # the tables whose size the shuffles of a query follow


def register(key: str, sql: str | None = None):
    def deco(fn):
        @wraps(fn)
        def sized(spark, sf_dir):
            size_shuffles(spark, sf_dir, FACTS)
            return fn(spark, sf_dir)
        QUERIES[key] = sized
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def mart_report(key: str, fn, sql: str | None, **kw):
    register(key, sql)(lambda spark, sf_dir: fn(P.materialised_mart(spark, sf_dir), **kw))


def rollup_report(key: str, fn, sql: str, **kw):
    """A report read from the stored partial aggregates of the mart."""
    register(key, sql)(lambda spark, sf_dir: fn(RU.fixture_rollups(spark, sf_dir), **kw))


# ---- the mart itself ----------------------------------------------------
register("daily_lane_equipment_prices", O.with_mart("SELECT * FROM mart"))(
    lambda spark, sf_dir: P.fixture_mart(spark, sf_dir))

# ---- saved queries Q1-Q22 ----------------------------------------------
_LATEST = "valid_day = (SELECT max(valid_day) FROM mart)"
mart_report("latest_by_lane", R.latest_by_lane, O.with_mart(
    f"SELECT {LANE} AS lane, median_price_usd, avg_price_usd FROM mart WHERE {_LATEST}"))
mart_report("latest_by_region", R.latest_by_region, O.with_mart(
    "SELECT origin_region_name, destination_region_name, count(*) AS lane_count, "
    "avg(avg_price_usd) AS avg_of_avg_price, avg(median_price_usd) AS avg_of_median_price "
    "FROM mart, (SELECT max(valid_day) AS max_day FROM mart) latest "
    "WHERE valid_day = latest.max_day GROUP BY 1, 2"))
mart_report("daily_avg_one_lane", R.daily_avg_one_lane, O.with_mart(
    "SELECT valid_day, avg(avg_price_usd) AS daily_avg_price FROM mart "
    f"WHERE origin_port_name = '{ONE_LANE[0]}' AND destination_port_name = '{ONE_LANE[1]}' "
    "GROUP BY valid_day"), origin=ONE_LANE[0], destination=ONE_LANE[1])
rollup_report("weekly_region_trend", RU.weekly_region_trend, O.with_mart(
    "SELECT CAST(date_trunc('week', valid_day) AS DATE) AS week_start, origin_region_name, "
    "destination_region_name, avg(avg_price_usd) AS weekly_avg_price FROM mart GROUP BY 1, 2, 3"))
rollup_report("mom_change", RU.mom_change, O.with_mart(
    "SELECT m AS month, concat(o, ' to ', t) AS lane, p AS monthly_avg_price, q AS prev_month_price, "
    "(p - q) / nullif(q, 0) AS mom_change_pct FROM (SELECT *, lag(p) OVER months AS q FROM ("
    "SELECT CAST(date_trunc('month', valid_day) AS DATE) AS m, origin_port_name AS o, "
    "destination_port_name AS t, avg(avg_price_usd) AS p FROM mart GROUP BY ALL) "
    "WINDOW months AS (PARTITION BY o, t ORDER BY m))"))
rollup_report("lane_monthly", RU.lane_monthly, O.with_mart(
    f"SELECT CAST(date_trunc('month', valid_day) AS DATE) AS month, {LANE} AS lane, "
    "avg(avg_price_usd) AS avg_price, avg(median_price_usd) AS median_price FROM mart GROUP BY 1, 2"))
mart_report("latest_leaderboard", R.latest_leaderboard, O.with_mart(
    f"SELECT {LANE} AS lane, avg_price_usd, median_price_usd FROM mart WHERE {_LATEST}"))
rollup_report("region_monthly", RU.region_monthly, O.with_mart(
    "SELECT CAST(date_trunc('month', valid_day) AS DATE) AS month, origin_region_name, "
    "destination_region_name, avg(avg_price_usd) AS avg_price FROM mart GROUP BY 1, 2, 3"))
mart_report("origin_regions_90d", R.origin_regions_90d, O.with_mart(
    "SELECT origin_region_name, avg(avg_price_usd) AS avg_price FROM mart, "
    "(SELECT max(valid_day) - 90 AS start_day, max(valid_day) AS max_day FROM mart) win "
    f"WHERE valid_day BETWEEN win.start_day AND win.max_day AND destination_region_name LIKE '{DEST_REGION}' "
    "GROUP BY origin_region_name"), destination_region=DEST_REGION)
rollup_report("price_by_equipment", RU.price_by_equipment, O.with_mart(
    "SELECT equipment_id, avg(avg_price_usd) AS avg_price FROM mart GROUP BY equipment_id"))
rollup_report("lane_equipment_avg", RU.lane_equipment_avg, O.with_mart(
    "SELECT origin_port_name, destination_port_name, equipment_id, avg(avg_price_usd) AS avg_price "
    "FROM mart GROUP BY 1, 2, 3"))
rollup_report("top10_lanes", RU.top10_lanes, O.with_mart(
    f"SELECT {LANE} AS lane, avg(avg_price_usd) AS avg_price FROM mart GROUP BY lane "
    "ORDER BY avg_price DESC, lane LIMIT 10"))
rollup_report("volatile_lanes", RU.volatile_lanes, O.with_mart(
    f"SELECT {LANE} AS lane, stddev_pop(avg_price_usd) AS price_volatility FROM mart GROUP BY lane "
    "ORDER BY price_volatility DESC, lane LIMIT 10"))
rollup_report("bad_data_rate", RU.bad_data_rate, O.with_mart(
    f"SELECT {LANE} AS lane, avg(CASE WHEN dq_ok THEN 0 ELSE 1 END) AS bad_data_rate FROM mart GROUP BY lane"))
mart_report("missing_price_rows", R.missing_price_rows, O.with_mart(
    "SELECT * FROM mart WHERE avg_price_usd IS NULL OR median_price_usd IS NULL "
    "ORDER BY valid_day, equipment_id, origin_port_id, destination_port_id LIMIT 100"))
rollup_report("lanes_by_equipment", RU.lanes_by_equipment, O.with_mart(
    "SELECT equipment_id, count(DISTINCT port_lane) AS lane_count FROM mart GROUP BY equipment_id"))
_YM = ("SELECT extract(year FROM valid_day) AS v_year, extract(month FROM valid_day) AS v_month, "
       "count(DISTINCT port_lane) AS lane_count FROM mart {where} GROUP BY 1, 2")
rollup_report("lanes_by_month", RU.lanes_by_month, O.with_mart(_YM.format(where="")))
rollup_report("valid_lanes_by_month", RU.valid_lanes_by_month, O.with_mart(_YM.format(where="WHERE dq_ok = true")))
rollup_report("expensive_lanes", RU.expensive_lanes, O.with_mart(
    "SELECT port_lane, avg(avg_price_usd) AS avg_price FROM mart GROUP BY port_lane"))
rollup_report("contract_days", RU.contract_days_by_lane, O.with_mart(
    "SELECT port_lane, count(valid_day) AS valid_days FROM mart GROUP BY port_lane"))
rollup_report("origin_activity", RU.origin_activity, O.with_mart(
    "SELECT origin_port_name, count(destination_port_name) AS destination_ports FROM mart "
    "GROUP BY origin_port_name"))
rollup_report("destination_activity", RU.destination_activity, O.with_mart(
    "SELECT destination_port_name, count(origin_port_name) AS origin_ports FROM mart "
    "GROUP BY destination_port_name"))

# ---- dashboard queries D1-D11 ------------------------------------------
from lanecast.plans import dashboards as D  # noqa: E402

# Dashboard inputs used for the fixture (codes / regions /
# countries of the fixture ports, date ranges inside the fixture years).
PAIR = ("NATION_1", "NATION_%")
RANGE_A = ("1996-01-01", "1999-12-31")
RANGE_B = ("1997-01-01", "1997-12-31")
RANGE_C = ("1998-01-01", "1998-12-31")
RANGE_D = ("2000-01-01", "2000-06-30")
AFTER_DAY = "2000-06-01"

_D1 = ("SELECT valid_day, equipment_id, origin_region_name, destination_region_name, origin_port_name, "
       f"destination_port_name, avg_price_usd, median_price_usd, dq_ok, {LANE} AS lane_description "
       "FROM mart WHERE dq_ok = TRUE AND equipment_id = coalesce({eq}, equipment_id)")
mart_report("daily_shipping_prices", D.daily_shipping_prices, O.with_mart(_D1.format(eq="NULL")))
mart_report("daily_shipping_prices_eq2", D.daily_shipping_prices, O.with_mart(_D1.format(eq="2")),
            equipment_id=2)
mart_report("dq_summary", D.dq_summary, O.with_mart(
    "SELECT valid_day, CAST(count_if(dq_ok) AS BIGINT) AS covered_lanes, "
    "CAST(count_if(NOT dq_ok) AS BIGINT) AS uncovered_lanes FROM mart GROUP BY valid_day"))
mart_report("dq_failures", D.dq_failures, O.with_mart(
    "SELECT valid_day, equipment_id, origin_port_name, destination_port_name, distinct_companies_count, "
    "distinct_suppliers_count FROM mart WHERE dq_ok = false"))
_D4 = ("SELECT valid_day, n AS total_lane_days, CAST(good AS BIGINT) AS reliable_lane_days, "
       "round(good * 100.0 / n, 2) AS pct_reliable FROM (SELECT valid_day, count(*) AS n, count_if(dq_ok) AS good "
       "FROM mart WHERE {eq} GROUP BY valid_day)")
mart_report("data_coverage", D.data_coverage, O.with_mart(_D4.format(eq="equipment_id IS NOT NULL")))
mart_report("data_coverage_eq1", D.data_coverage, O.with_mart(_D4.format(eq="equipment_id = 1")), equipment_id=1)
mart_report("dq_failure_reason", D.dq_failure_reason, O.with_mart(
    "SELECT valid_day, origin_port_code, destination_port_code, equipment_id, "
    "CASE WHEN distinct_companies_count < 5 THEN 'Needs more companies' "
    "WHEN distinct_suppliers_count < 2 THEN 'Needs more suppliers' ELSE 'OK' END AS dq_issue "
    f"FROM mart WHERE NOT dq_ok AND valid_day > DATE '{AFTER_DAY}'"), after=AFTER_DAY)
mart_report("port_pair_series", D.port_pair_series, O.with_mart(
    "SELECT valid_day, avg_price_usd, median_price_usd FROM mart "
    f"WHERE origin_port_code LIKE '{PAIR[0]}' AND destination_port_code LIKE '{PAIR[1]}' "
    "AND equipment_id = coalesce(NULL, equipment_id) AND dq_ok = TRUE "
    f"AND valid_day BETWEEN '{RANGE_A[0]}' AND '{RANGE_A[1]}'"),
    origin_code=PAIR[0], destination_code=PAIR[1], start=RANGE_A[0], end=RANGE_A[1])
mart_report("port_pair_series_all", D.port_pair_series, O.with_mart(
    "SELECT valid_day, avg_price_usd, median_price_usd FROM mart "
    "WHERE origin_port_code LIKE '%' AND destination_port_code LIKE '%' "
    "AND equipment_id = coalesce(NULL, equipment_id) AND dq_ok = TRUE "
    f"AND valid_day BETWEEN '{RANGE_B[0]}' AND '{RANGE_B[1]}'"), start=RANGE_B[0], end=RANGE_B[1])
mart_report("avg_median_gap", D.avg_median_gap, O.with_mart(
    "SELECT valid_day, avg_price_usd, median_price_usd, (avg_price_usd - median_price_usd) AS avg_median_diff "
    "FROM mart WHERE origin_port_code LIKE 'NATION_2' AND destination_port_code LIKE '%' "
    "AND equipment_id = coalesce(2, equipment_id) AND dq_ok = TRUE"),
    origin_code="NATION_2", destination_code="%", equipment_id=2)
mart_report("region_pair_series", D.region_pair_series, O.with_mart(
    "SELECT valid_day, avg(avg_price_usd) AS region_avg_price_usd, count(*) AS number_of_underlying_lanes "
    f"FROM (SELECT * FROM mart WHERE valid_day >= DATE '{RANGE_B[0]}' AND valid_day <= DATE '{RANGE_B[1]}') "
    f"WHERE dq_ok AND origin_region_name = '{DEST_REGION}' GROUP BY valid_day"),
    origin_region=DEST_REGION, start=RANGE_B[0], end=RANGE_B[1])
mart_report("most_expensive_lanes", D.most_expensive_lanes, O.with_mart(
    "SELECT origin_port_name, origin_region_name, destination_port_name, destination_region_name, "
    f"avg_price_usd, {LANE} AS lane_description FROM mart "
    f"WHERE valid_day BETWEEN '{RANGE_C[0]}' AND '{RANGE_C[1]}' AND dq_ok = TRUE "
    "AND equipment_id = coalesce(NULL, equipment_id) "
    "ORDER BY avg_price_usd DESC, valid_day, equipment_id, origin_port_id, destination_port_id LIMIT 20"),
    start=RANGE_C[0], end=RANGE_C[1])
mart_report("country_lanes", D.country_lanes, O.with_mart(
    "SELECT valid_day, origin_country_code, origin_port_code, equipment_id, avg_price_usd FROM mart "
    f"WHERE destination_country_code LIKE '{DEST_COUNTRY}' AND dq_ok = TRUE "
    f"AND valid_day BETWEEN '{RANGE_D[0]}' AND '{RANGE_D[1]}'"),
    destination_country=DEST_COUNTRY, start=RANGE_D[0], end=RANGE_D[1])


def staged_report(key: str, fn, table: str, sql: str):
    register(key, O.with_mart(sql))(
        lambda spark, sf_dir: fn(getattr(P.materialised_staging(spark, sf_dir), table)))


staged_report("equipment_types", D.equipment_types, "datapoints",
              "SELECT equipment_id FROM stg_datapoints GROUP BY equipment_id")
staged_report("port_codes", D.port_codes, "ports", "SELECT code FROM stg_ports GROUP BY code")
staged_report("region_names", D.region_names, "regions", "SELECT name FROM stg_regions GROUP BY name")
staged_report("country_codes", D.country_codes, "ports",
              "SELECT country_code FROM stg_ports GROUP BY country_code")
staged_report("lane_list", D.lane_list, "datapoints",
              "SELECT concat(origin_port_id, ' - ', destination_port_id) AS lane_description "
              "FROM stg_datapoints GROUP BY origin_port_id, destination_port_id")

# ---- incremental pipeline: batch 1 full build, batch 2 incremental -----
from lanecast.operators import coverage as C  # noqa: E402
from lanecast.operators import incremental as I  # noqa: E402
from lanecast.sources import fixtures as FX  # noqa: E402

_B = P.SNAPSHOT_TS
_RAW_DP = "d_id, created, origin_pid, destination_pid, valid_from, valid_to, company_id, supplier_id, equipment_id"


@register("incremental_new_rows", O.with_batches(
    f"SELECT {_RAW_DP}, 'orders.parquet' AS file_path, 'incremental' AS load_type, "
    f"DATE '{FX.BATCH2_LOAD_DATE}' AS load_date FROM raw_dp2_new", _B))
def _q_incremental_new_rows(spark, sf_dir):
    b1, b2 = FX.batches(spark, sf_dir)
    return I.incremental_new_rows(b2.datapoints, b1.datapoints)


@register("charges_new_only", O.with_batches(
    "SELECT d_id, currency, charge_value, 'lineitem.parquet' AS file_path, 'incremental' AS load_type, "
    f"DATE '{FX.BATCH2_LOAD_DATE}' AS load_date FROM raw_ch2_new", _B))
def _q_charges_new_only(spark, sf_dir):
    b1, b2 = FX.batches(spark, sf_dir)
    return I.charges_new_only(b2.charges, b1.charges)


def _batch_staged(spark, sf_dir):
    return P.stored_staged(spark, P.materialised_batches(spark, sf_dir))


register("stg_increment", O.with_batches("SELECT * FROM stg_datapoints2", _B))(
    lambda spark, sf_dir: _batch_staged(spark, sf_dir).datapoints)
register("charges_upsert", O.with_batches("SELECT * FROM stg_charges2", _B))(
    lambda spark, sf_dir: _batch_staged(spark, sf_dir).charges)


def _mart1_paths(spark, sf_dir):
    """The run's root and the mart as it stood after batch 1 (a snapshot the run wrote)."""
    root = P.materialised_batches(spark, sf_dir)
    return root, P.TB.table_path(root, *P.MART_B1_TABLE)


register("affected_window", O.with_batches("SELECT lo, hi FROM win", _B))(
    lambda spark, sf_dir: P.affected_window(spark, *_mart1_paths(spark, sf_dir)))


@register("affected_window_expand", O.with_batches("SELECT * FROM mart2", _B))
def _q_affected_rows(spark, sf_dir):
    rows, _ = P.affected_rows(spark, *_mart1_paths(spark, sf_dir), P.M.MartParams(load_date=FX.BATCH2_LOAD_DATE))
    return rows


register("mart_upsert", O.with_batches("SELECT * FROM final", _B))(
    lambda spark, sf_dir: P.stored_mart(spark, P.materialised_batches(spark, sf_dir)).drop("valid_month"))


def _cov_log(spark, sf_dir):
    return P.coverage_log_table(spark, P.materialised_batches(spark, sf_dir))


register("coverage_snapshot", O.with_batches("SELECT * FROM cov_log", _B))(_cov_log)
register("coverage_log", O.with_batches("SELECT snapshot_ts, stage, covered_lane_count FROM cov_log", _B))(
    lambda spark, sf_dir: D.coverage_log(_cov_log(spark, sf_dir)))
register("coverage_changes", O.with_batches("", _B).rstrip() + O.COVERAGE_CHANGES_SQL.format(log="cov_log"))(
    lambda spark, sf_dir: C.coverage_changes(_cov_log(spark, sf_dir)))

# ---- data-quality checks (C1-C6) ----------------------------------------
from lanecast.operators import quality as Q  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

_SQL_TABLE = {"charges": "stg_charges", "datapoints": "stg_datapoints", "exchange_rates": "stg_exchange_rates",
              "ports": "stg_ports", "regions": "stg_regions", "daily_lane_equipment_prices": "mart"}


def _dq_tables(spark, sf_dir):
    st = P.materialised_staging(spark, sf_dir)
    t = {n: getattr(st, n) for n in P.RAW_NAMES}
    t["daily_lane_equipment_prices"] = P.materialised_mart(spark, sf_dir).drop("valid_month")
    return t


def _sql_lit(v):
    return ("true" if v else "false") if isinstance(v, bool) else str(v)


def _dq_sql(kind):
    parts = []
    if kind == "not_null":
        for m, cols in Q.NOT_NULL.items():
            for c in cols:
                parts.append(f"SELECT 'not_null' AS test_name, '{m}' AS model, '{c}' AS column_name, "
                             f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {_SQL_TABLE[m]}")
    elif kind == "unique":
        for m, c in Q.UNIQUE.items():
            parts.append(f"SELECT 'unique' AS test_name, '{m}' AS model, '{c}' AS column_name, count(*) AS failures FROM (SELECT {c} FROM {_SQL_TABLE[m]} "
                         f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) d")
    elif kind == "relationships":
        for cm, cc, pm, pc in Q.RELATIONSHIPS:
            parts.append(f"SELECT 'relationships' AS test_name, '{cm}' AS model, '{cc}' AS column_name, "
                         f"count(*) AS failures FROM {_SQL_TABLE[cm]} c "
                         f"LEFT JOIN (SELECT DISTINCT {pc} AS k FROM {_SQL_TABLE[pm]}) p ON c.{cc} = p.k "
                         f"WHERE c.{cc} IS NOT NULL AND p.k IS NULL")
    elif kind == "accepted_values":
        for m, c, vals in Q.ACCEPTED_VALUES:
            lst = ", ".join(_sql_lit(v) for v in vals)
            parts.append(f"SELECT 'accepted_values' AS test_name, '{m}' AS model, '{c}' AS column_name, "
                         f"count(*) AS failures FROM (SELECT DISTINCT {c} "
                         f"FROM {_SQL_TABLE[m]} WHERE {c} NOT IN ({lst})) d")
    return O.with_mart("\nUNION ALL\n".join(parts))


for _kind in ("not_null", "unique", "relationships", "accepted_values"):
    register(f"dq_{_kind}", _dq_sql(_kind))(
        (lambda kind: lambda spark, sf_dir: Q.run_checks(_dq_tables(spark, sf_dir), (kind,)))(_kind))


mart_report("dq_ok", lambda mart: mart.groupBy("dq_ok").agg(F.count(F.lit(1)).alias("lane_days")),
    O.with_mart("SELECT dq_ok, count(*) AS lane_days FROM mart GROUP BY dq_ok"))

# ---- CSV ingestion (S1-S13) ---------------------------------------------
from lanecast.sources import csv as CSV  # noqa: E402

_RAW_COLS = {
    "ports": "pid, code, slug, name, country, country_code",
    "regions": "slug, name, parent",
    "exchange_rates": "day, currency, rate",
    "datapoints": _RAW_DP,
    "charges": "d_id, currency, charge_value",
}
_SCAN_SRC = {"ports": "raw_ports", "regions": "raw_regions", "exchange_rates": "raw_exchange_rates",
             "datapoints": "raw_dp1", "charges": "raw_ch1"}


def _scan_sql(t, src, folder, load_date):
    """Rows a scan of the table's files gives."""
    return (f"SELECT {_RAW_COLS[t]}, '{folder}/{CSV.GLOBS[t]}' AS file_path, '{folder}' AS load_type, "
            f"DATE '{load_date}' AS load_date FROM {src}")


for _t, _key in (("ports", "scan_ports"), ("regions", "scan_regions"), ("exchange_rates", "scan_rates"),
                 ("datapoints", "scan_datapoints"), ("charges", "scan_charges")):
    register(_key, O.with_batches(_scan_sql(_t, _SCAN_SRC[_t], "full_load", FX.BATCH1_LOAD_DATE), _B))(
        (lambda t: lambda spark, sf_dir: CSV.scan(spark, P.materialised_inputs(spark, sf_dir), t, "full",
                                                  FX.BATCH1_LOAD_DATE))(_t))


@register("load_raw", O.with_batches(
    _scan_sql("datapoints", "raw_dp1", "full_load", FX.BATCH1_LOAD_DATE) + " UNION ALL "
    + _scan_sql("datapoints", "raw_dp2_batch", "incremental", FX.BATCH2_LOAD_DATE), _B))
def _q_load_raw(spark, sf_dir):
    """Full load replaced, then the incremental folder appended (datapoints)."""
    root = P.materialised_inputs(spark, sf_dir)
    full = CSV.load_raw(spark, root, "full", FX.BATCH1_LOAD_DATE, ("datapoints",))["datapoints"]
    inc = CSV.load_raw(spark, root, "incremental", FX.BATCH2_LOAD_DATE, ("datapoints",))["datapoints"]
    return full.unionByName(inc)


_FILES = [("full_load", "DE_casestudy_ports.csv", "ports", "raw_ports"),
          ("full_load", "DE_casestudy_regions.csv", "regions", "raw_regions"),
          ("full_load", "DE_casestudy_exchange_rates.csv", "exchange_rates", "raw_exchange_rates"),
          ("full_load", "DE_casestudy_datapoints_1.csv", "datapoints", "raw_dp1"),
          ("full_load", "DE_casestudy_charges_1.csv", "charges", "raw_ch1"),
          ("incremental", "DE_casestudy_datapoints_2.csv", "datapoints", "raw_dp2_batch"),
          ("incremental", "DE_casestudy_charges_2.csv", "charges", "raw_ch2_batch")]


@register("file_row_counts", O.with_batches(" UNION ALL ".join(
    f"SELECT '{f}' AS file_name, '{t}' AS table_name, count(*) AS row_count FROM {src}"
    for _, f, t, src in _FILES), _B))
def _q_file_row_counts(spark, sf_dir):
    root = P.materialised_inputs(spark, sf_dir)
    return CSV.file_inventory(spark, f"{root}/full_load").unionByName(
        CSV.file_inventory(spark, f"{root}/incremental"))

# ---- streaming re-aim of the raw increment ------------------------------
from lanecast.streaming import ingest as ST  # noqa: E402


@register("stream_ingest", O.with_batches(
    _scan_sql("datapoints", "raw_dp1", "full_load", FX.BATCH1_LOAD_DATE) + " UNION ALL "
    + _scan_sql("datapoints", "raw_dp2_new", "incremental", FX.BATCH2_LOAD_DATE), _B))
def _q_stream_ingest(spark, sf_dir):
    """Full-load scan stored as the raw table, then the incremental folder
    streamed into it (availableNow + foreachBatch upsert)."""
    from lanecast.session import scratch_path
    root = P.materialised_inputs(spark, sf_dir)
    target = scratch_path(spark, "stream", "raw_datapoints")
    P.TB.overwrite(CSV.scan(spark, root, "datapoints", "full", FX.BATCH1_LOAD_DATE), target)
    ST.run_datapoint_stream(spark, root, target, scratch_path(spark, "stream", "checkpoint"),
                            FX.BATCH2_LOAD_DATE)
    return P.TB.read(spark, target, P.raw_schema("datapoints"))

# ---- staging layer, expansion, contract-day price, extracts -------------
for _t in P.RAW_NAMES:
    register(f"stg_{_t}", O.with_mart(f"SELECT * FROM stg_{_t}"))(
        (lambda t: lambda spark, sf_dir: getattr(P.materialised_staging(spark, sf_dir), t))(_t))


register("validity_expand", O.with_mart(
    "SELECT datapoint_id, created, company_id, supplier_id, equipment_id, origin_port_id, "
    "destination_port_id, valid_day FROM mart_expanded"))(
    lambda spark, sf_dir: P.M.validity_expand(P.materialised_staging(spark, sf_dir).datapoints))


@register("contract_daily_price", O.with_mart(
    "SELECT datapoint_id, valid_day, company_id, supplier_id, equipment_id, origin_port_id, "
    "destination_port_id, created, total_usd_price FROM mart_total"))
def _q_contract_daily_price(spark, sf_dir):
    st = P.materialised_staging(spark, sf_dir)
    return P.M.contract_daily_price(P.M.contract_days(st.datapoints, st.charges), st.exchange_rates)


register("extract_mart", O.with_mart("SELECT * FROM mart"))(
    lambda spark, sf_dir: P.materialised_mart(spark, sf_dir).drop("valid_month"))


@register("schema_evolve", O.with_batches(
    f"SELECT {_RAW_DP}, CAST(NULL AS BIGINT) AS contract_tier FROM raw_dp1 "
    "WHERE d_id NOT IN (SELECT d_id FROM raw_dp2_new) UNION ALL "
    f"SELECT {_RAW_DP}, d_id % 3 AS contract_tier FROM raw_dp2_new", _B))
def _q_schema_evolve(spark, sf_dir):
    """Batch 2 arrives with an extra source column (derived here from the
    contract id) and goes through the raw step of an incremental run; the
    stored table has the column, NULL in the rows of batch 1."""
    from lanecast.session import scratch_path
    b1, b2 = FX.batches(spark, sf_dir)
    path = scratch_path(spark, "evolve", "datapoints")
    P.TB.overwrite(b1.datapoints, path)
    P.merge_raw_datapoints(spark, b2.datapoints.withColumn("contract_tier", F.col("d_id") % 3), path)
    return P.TB.read_evolved(spark, path).drop(*schemas.AUDIT.fieldNames())


@register("mart_from_files", O.with_batches("SELECT * FROM mart1", _B))
def _q_mart_from_files(spark, sf_dir):
    """The mart built end to end from the CSV input folder."""
    from lanecast.session import scratch_path
    root = scratch_path(spark, "from-files")
    P.run_full_from(spark, P.materialised_inputs(spark, sf_dir), root, FX.BATCH1_LOAD_DATE)
    return P.stored_mart(spark, root).drop("valid_month")


@register("load_tables", O.with_batches(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {src}" for t, src in (
        ("ports", "raw_ports"), ("regions", "raw_regions"), ("exchange_rates", "raw_exchange_rates"),
        ("datapoints", "(SELECT d_id FROM raw_dp1 UNION ALL SELECT d_id FROM raw_dp2_batch)"),
        ("charges", "(SELECT d_id FROM raw_ch1 UNION ALL SELECT d_id FROM raw_ch2_batch)"))), _B))
def _q_load_tables(spark, sf_dir):
    """All five raw tables written by the loader: replaced by the full load,
    fact tables appended by the incremental one."""
    from lanecast.session import scratch_path
    inputs, root = P.materialised_inputs(spark, sf_dir), scratch_path(spark, "loaded")
    CSV.load_tables(spark, inputs, root, "full", FX.BATCH1_LOAD_DATE)
    CSV.load_tables(spark, inputs, root, "incremental", FX.BATCH2_LOAD_DATE)
    parts = [P.TB.read_evolved(spark, P.TB.table_path(root, "raw", t)).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in P.RAW_NAMES]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


_CONTRACTS = {n: schemas.STAGING[n] for n in P.RAW_NAMES} | {"daily_lane_equipment_prices": schemas.MART}


@register("dq_contract", O.with_mart("\nUNION ALL\n".join(
    f"SELECT 'contract' AS test_name, '{m}' AS model, unnest([{', '.join(repr(c) for c in want.fieldNames())}]) AS column_name, "
    f"rows_checked, CAST(0 AS BIGINT) AS failures FROM (SELECT count(*) AS rows_checked FROM {_SQL_TABLE[m]})"
    for m, want in _CONTRACTS.items())))
def _q_dq_contract(spark, sf_dir):
    """Names and types in the files of every staging table and of the mart,
    whose month is where its files lie."""
    P.materialised_mart(spark, sf_dir)
    stored = P.contract_folders(spark, P.materialised_root(spark, sf_dir))
    month = F.col("column_name") == "valid_month"
    return Q.contract_checks(spark, [(m, stored[m], want) for m, want in _CONTRACTS.items()]).filter(~month)

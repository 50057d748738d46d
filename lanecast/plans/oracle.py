"""DuckDB SQL used as the correctness oracle.

Written from the semantics, not from a plan: contracts meet a calendar by an
interval join, charge totals meet rates, lane-days are aggregated on ids and
named last.  The fixture CTEs build the same raw rows as
``lanecast.sources.fixtures`` from the pre-registered driver tables.
"""

from __future__ import annotations

from lanecast.sources import fixtures as fx

LOAD_DATE = fx.FULL_LOAD_DATE

FIXTURE_CTES = f"""
cal AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi + {fx.MAX_VALIDITY_DAYS} AS TIMESTAMP),
                                     INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders)
),
raw_regions AS (
  SELECT concat('Region_', CAST(r_regionkey AS VARCHAR)) AS slug, r_name AS name,
         CASE WHEN r_regionkey > 0 THEN 'region_0' END AS parent
  FROM region
),
raw_ports AS (
  SELECT CAST(n_nationkey AS BIGINT) AS pid, lower(n_name) AS code,
         concat('region_', CAST(n_regionkey AS VARCHAR)) AS slug, n_name AS name,
         n_name AS country, concat('c', CAST(n_regionkey AS VARCHAR)) AS country_code
  FROM nation
  UNION ALL
  SELECT CAST(n_nationkey AS BIGINT), lower(n_name), concat('region_', CAST(n_regionkey AS VARCHAR)),
         n_name, n_name, concat('c', CAST(n_regionkey AS VARCHAR))
  FROM nation WHERE n_nationkey IN (2, 7)
),
base_dp AS (
  SELECT o_orderkey AS d_id, CAST(o_orderdate AS TIMESTAMP) AS created,
         CAST(if(o_custkey % 4 = 0, o_custkey % 13, o_custkey % 3) AS BIGINT) AS origin_pid,
         CAST(CASE WHEN o_orderkey % 97 = 0 THEN 99 WHEN o_orderkey % 4 = 1 THEN o_orderkey % 12 + 13
                   ELSE o_orderkey % 2 + 13 END AS BIGINT) AS destination_pid,
         CAST(o_orderdate AS DATE) AS valid_from,
         CAST(CAST(o_orderdate AS DATE)
              + CAST(CASE WHEN o_orderkey % 50 = 0 THEN -1 ELSE (o_orderkey * 7) % 60 END AS INTEGER) AS DATE) AS valid_to,
         o_custkey AS company_id, CAST(o_orderkey % 4 AS BIGINT) AS supplier_id,
         CAST(if(o_orderkey % 5 = 0, 1 + (o_orderkey // 5) % 6, 1 + o_orderkey % 2) AS BIGINT) AS equipment_id
  FROM orders
),
raw_datapoints AS (
  SELECT * FROM base_dp
  UNION ALL
  SELECT d_id, created + INTERVAL 1 DAY, origin_pid, destination_pid, valid_from, valid_to,
         company_id, supplier_id + 4, equipment_id
  FROM base_dp WHERE d_id % 10 = 3
),
raw_charges AS (
  SELECT l_orderkey AS d_id,
         CASE WHEN l_linenumber = 7 THEN NULL
              WHEN l_linenumber = 6 AND l_quantity < 5 THEN ''
              WHEN l_returnflag = 'A' THEN 'USD'
              WHEN l_returnflag = 'N' THEN ' EUR '
              ELSE 'NOK' END AS currency,
         CAST(floor(l_extendedprice) AS DOUBLE) AS charge_value
  FROM lineitem
),
raw_exchange_rates AS (
  SELECT day, currency,
         CAST(CASE WHEN currency = 'NOK' AND extract(day FROM day) = 13 THEN 0
                   WHEN currency = 'USD' THEN 1 WHEN currency = 'EUR' THEN 0.5 ELSE 8 END
              * (CASE WHEN currency <> 'USD' AND extract(day FROM day) % 2 = 0 THEN 2 ELSE 1 END) AS DOUBLE) AS rate
  FROM cal CROSS JOIN (SELECT 'USD' AS currency UNION ALL SELECT 'EUR' UNION ALL SELECT 'NOK') c
  WHERE NOT (currency = 'EUR' AND extract(day FROM day) = 29)
)"""


def staging_ctes(raw_dp: str = "raw_datapoints", raw_ch: str = "raw_charges",
                 load_date: str = LOAD_DATE, suffix: str = "") -> str:
    """Staging CTEs over the named raw CTEs (suffix distinguishes batches)."""
    return f"""
stg_regions{suffix} AS (
  SELECT DISTINCT lower(slug) AS slug, name, parent, DATE '{load_date}' AS load_date FROM raw_regions
),
stg_ports{suffix} AS (
  SELECT p.pid AS port_id, upper(p.code) AS code, lower(p.slug) AS slug, p.name AS name,
         p.country AS country, upper(p.country_code) AS country_code, r.name AS region_name,
         DATE '{load_date}' AS load_date
  FROM (SELECT DISTINCT * FROM raw_ports) p
  JOIN (SELECT DISTINCT lower(slug) AS slug, name FROM raw_regions) r ON p.slug = r.slug
),
stg_exchange_rates{suffix} AS (
  SELECT day AS exchange_date, currency, min(rate) AS rate, DATE '{load_date}' AS load_date
  FROM raw_exchange_rates GROUP BY day, currency
),
stg_datapoints{suffix} AS (
  SELECT d_id AS datapoint_id, created, origin_pid AS origin_port_id,
         destination_pid AS destination_port_id, valid_from, valid_to, company_id, supplier_id,
         equipment_id, DATE '{load_date}' AS load_date
  FROM (SELECT *, row_number() OVER (PARTITION BY d_id ORDER BY created DESC) AS rn FROM {raw_dp}) d
  WHERE rn = 1 AND valid_from <= valid_to
),
stg_charges{suffix} AS (
  SELECT d_id AS datapoint_id, trim(currency) AS currency, CAST(charge_value AS BIGINT) AS charge_value, DATE '{load_date}' AS load_date
  FROM {raw_ch} WHERE currency IS NOT NULL
)"""


def mart_ctes(name: str = "mart", dp: str = "stg_datapoints", ch: str = "stg_charges",
              rates: str = "stg_exchange_rates", ports: str = "stg_ports",
              load_date: str = LOAD_DATE, day_filter: str = "TRUE") -> str:
    """Mart CTE ``name``: contracts meet the calendar by an interval join, the
    charge totals of a currency meet its non-zero rates, the lane-days are
    aggregated on ids alone and named last.  ``day_filter`` is a predicate
    over the calendar day ``k.day``."""
    side = lambda at, end: ", ".join(
        f"{at}.{c} AS {end}_{o}" for c, o in (("port_id", "port_id"), ("code", "port_code"), ("name", "port_name"),
                                              ("region_name", "region_name"), ("country_code", "country_code")))
    return f"""
{name}_expanded AS (
  SELECT d.* EXCLUDE (valid_from, valid_to, load_date), k.day AS valid_day
  FROM {dp} d JOIN cal k ON k.day BETWEEN d.valid_from AND d.valid_to WHERE {day_filter}
),
{name}_total AS (
  SELECT x.datapoint_id, x.valid_day, x.company_id, x.supplier_id, x.equipment_id, x.origin_port_id,
         x.destination_port_id, x.created, sum(s.amount / r.rate) AS total_usd_price
  FROM (SELECT datapoint_id, currency, sum(charge_value) AS amount FROM {ch} GROUP BY ALL) s
  JOIN {name}_expanded x USING (datapoint_id)
  JOIN {rates} r ON r.currency = s.currency AND r.exchange_date = x.valid_day AND r.rate <> 0
  GROUP BY ALL
),
{name} AS (
  SELECT g.valid_day, g.equipment_id, concat(a.name, ' to ', z.name) AS port_lane, {side('a', 'origin')},
         {side('z', 'destination')}, round(g.mean, 2) AS avg_price_usd, round(g.middle, 2) AS median_price_usd,
         g.companies AS distinct_companies_count, g.suppliers AS distinct_suppliers_count,
         g.companies >= 5 AND g.suppliers >= 2 AS dq_ok, g.created, DATE '{load_date}' AS load_date
  FROM (SELECT valid_day, equipment_id, origin_port_id AS o, destination_port_id AS t,
               avg(total_usd_price) AS mean, quantile_cont(total_usd_price, 0.5) AS middle,
               count(DISTINCT company_id) AS companies, count(DISTINCT supplier_id) AS suppliers,
               max(created) AS created
        FROM {name}_total GROUP BY 1, 2, 3, 4) g
  JOIN {ports} z ON z.port_id = g.t
  JOIN {ports} a ON a.port_id = g.o
)"""


def with_mart(select_sql: str, extra_ctes: str = "") -> str:
    """Full oracle query: fixtures -> staging -> mart (+ ``extra_ctes``),
    then ``select_sql`` reading the CTE ``mart``."""
    extra = ("," + extra_ctes) if extra_ctes else ""
    return "WITH " + FIXTURE_CTES + "," + staging_ctes() + "," + mart_ctes() + extra + "\n" + select_sql


B1_DATE, B2_DATE = fx.BATCH1_LOAD_DATE, fx.BATCH2_LOAD_DATE
_CUT = f"TIMESTAMP '{fx.BATCH_CUT}'"
_MART_KEY = ("valid_day", "equipment_id", "origin_port_id", "destination_port_id")


def _anti_key(left: str, right: str, key=_MART_KEY) -> str:
    cond = " AND ".join(f"r.{k} = l.{k}" for k in key)
    return f"SELECT l.* FROM {left} l WHERE NOT EXISTS (SELECT 1 FROM {right} r WHERE {cond})"


def batch_ctes() -> str:
    """Batch 1 full build, batch 2 incremental run, in the source's terms:
    raw increments (created watermark, NOT IN), staging delta upserts,
    mart1, the affected window, mart2 over its days, and
    the delete+insert result ``final``; ``cov_log`` holds the snapshots."""
    return ("WITH " + FIXTURE_CTES + f""",
raw_dp1 AS (SELECT * FROM raw_datapoints WHERE created < {_CUT}),
raw_dp2_batch AS (SELECT * FROM raw_datapoints WHERE created >= {_CUT}),
raw_ch1 AS (SELECT * FROM raw_charges WHERE d_id IN (SELECT d_id FROM raw_dp1)),
raw_ch2_batch AS (SELECT * FROM raw_charges WHERE d_id IN (SELECT d_id FROM raw_dp2_batch)
                  AND d_id NOT IN (SELECT d_id FROM raw_dp1)),
raw_dp2_new AS (SELECT * FROM raw_dp2_batch WHERE created > (SELECT max(created) FROM raw_dp1)),
raw_ch2_new AS (SELECT * FROM raw_ch2_batch WHERE d_id NOT IN (SELECT DISTINCT d_id FROM raw_ch1)),"""
            + staging_ctes("raw_dp1", "raw_ch1", B1_DATE, "1") + ","
            + mart_ctes("mart1", "stg_datapoints1", "stg_charges1", "stg_exchange_rates1", "stg_ports1",
                        B1_DATE) + ","
            + staging_ctes("raw_dp2_new", "raw_ch2_new", B2_DATE, "2d") + f""",
stg_datapoints2 AS (
  SELECT * FROM stg_datapoints1 WHERE datapoint_id NOT IN (SELECT datapoint_id FROM stg_datapoints2d)
  UNION ALL SELECT * FROM stg_datapoints2d),
stg_charges2 AS (
  SELECT * FROM stg_charges1 WHERE datapoint_id NOT IN (SELECT datapoint_id FROM stg_charges2d)
  UNION ALL SELECT * FROM stg_charges2d),
win AS (SELECT min(valid_from) AS lo, max(valid_to) AS hi FROM stg_datapoints2
        WHERE created > (SELECT max(created) FROM mart1)),"""
            + mart_ctes("mart2", "stg_datapoints2", "stg_charges2", "stg_exchange_rates2d", "stg_ports2d",
                        B2_DATE,
                        day_filter="k.day BETWEEN (SELECT lo FROM win) AND (SELECT hi FROM win)")
            + f""",
final AS ({_anti_key('mart1', 'mart2')} UNION ALL SELECT * FROM mart2),
cov_log AS (
  SELECT TIMESTAMP '{{b_ts}}' AS snapshot_ts, 'before' AS stage,
         (SELECT count(*) FROM mart1 WHERE dq_ok = true) AS covered_lane_count
  UNION ALL
  SELECT TIMESTAMP '{{a_ts}}', 'after', (SELECT count(*) FROM final WHERE dq_ok = true))
""")


def with_batches(select_sql: str, snapshot_ts: tuple[str, str]) -> str:
    return batch_ctes().replace("{b_ts}", snapshot_ts[0]).replace("{a_ts}", snapshot_ts[1]) + select_sql


COVERAGE_CHANGES_SQL = """
SELECT x.snapshot_ts AS before_ts, y.snapshot_ts AS after_ts, x.n AS before_count, y.n AS after_count,
       y.n - x.n AS diff_count, round((y.n - x.n) * 100.0 / nullif(x.n, 0), 2) AS pct_change
FROM (SELECT snapshot_ts, max(covered_lane_count) AS n FROM {log} WHERE stage = 'before' GROUP BY 1) x
ASOF JOIN (SELECT snapshot_ts, covered_lane_count AS n FROM {log} WHERE stage = 'after') y
  ON x.snapshot_ts < y.snapshot_ts"""

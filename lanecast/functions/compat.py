"""Column expressions whose results must equal the oracle database's.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def duck_round(x: ColumnOrName, digits: int = 2) -> Column:
    """round(double, n) as the oracle computes it: scale, round half away
    from zero, unscale; a value too large to scale stays as it is.
    1.005 -> 1.0 (Spark's ``round`` of the unscaled value would give 1.01)."""
    m = float(10 ** digits)
    v = _c(x).cast("double")
    scaled = v * F.lit(m)
    return F.when(F.abs(scaled) == F.lit(float("inf")), v).otherwise(F.round(scaled, 0) / F.lit(m))


def concat_text(*parts: ColumnOrName) -> Column:
    """Text concat that skips NULL parts (the oracle's ``concat``)."""
    return F.concat_ws("", *[_c(p).cast("string") for p in parts])


def lane_label(origin: ColumnOrName = "origin_port_name",
               destination: ColumnOrName = "destination_port_name") -> Column:
    """'<origin> to <destination>' — the port_lane / lane text."""
    return concat_text(origin, F.lit(" to "), destination)


def safe_day_series(lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """Inclusive array of days lo..hi; empty when lo > hi or either is NULL
    (Spark's ``sequence`` raises on reversed bounds)."""
    lo, hi = _c(lo), _c(hi)
    return F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))) \
            .otherwise(F.array().cast("array<date>"))


def dq_ok(companies: ColumnOrName = "distinct_companies_count",
          suppliers: ColumnOrName = "distinct_suppliers_count",
          min_companies: int = 5, min_suppliers: int = 2) -> Column:
    """Coverage rule: enough distinct companies AND suppliers."""
    return (_c(companies) >= F.lit(min_companies)) & (_c(suppliers) >= F.lit(min_suppliers))


def percent(part: ColumnOrName, whole: ColumnOrName, digits: int = 2) -> Column:
    """round(part * 100.0 / whole, digits) in double; NULL when whole is 0."""
    return duck_round(F.try_divide(_c(part).cast("double") * F.lit(100.0),
                                   _c(whole).cast("double")), digits)


def like_or_all(col: ColumnOrName, pattern: str | None) -> Column:
    """``col LIKE pattern``.  '%' (the dashboards' 'all') and None keep every
    non-NULL value, exactly like the LIKE would, without a LIKE to evaluate."""
    c = _c(col)
    if pattern is None or pattern == "%":
        return c.isNotNull()
    return c.like(pattern)


def optional_eq(col: ColumnOrName, value) -> Column:
    """``col = coalesce(value, col)``: NULL parameter keeps all non-NULL rows."""
    c = _c(col)
    return c.isNotNull() if value is None else (c == F.lit(value))


def as_date(value) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.isoformat()[:10]
    return F.lit(value).cast("date")


# File-name clean-up patterns of the loader, applied in this
# order, then any character outside [a-zA-Z0-9_] becomes '_' and the result
# is lower-cased.
TABLE_NAME_STRIP = [r"^DE_", r"^DE_casestudy_", r"^casestudy_", r"_\d+$"]


def table_name_from_file(stem: ColumnOrName) -> Column:
    """File stem -> table name (e.g. DE_casestudy_charges_2 -> charges)."""
    c = _c(stem)
    for p in TABLE_NAME_STRIP:
        c = F.regexp_replace(c, p, "")
    return F.lower(F.regexp_replace(c, r"[^a-zA-Z0-9_]", "_"))


def file_stem(path: ColumnOrName) -> Column:
    """Base name without directory and the last extension."""
    base = F.regexp_extract(_c(path), r"([^/]+)$", 1)
    return F.regexp_replace(base, r"\.[^.]*$", "")

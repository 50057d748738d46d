"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import math

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL

KEYS = sorted(queries())


def _norm(v):
    return v.isoformat() if hasattr(v, "isoformat") else v


def _sorted_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    fixed = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(fixed, key=lambda t: tuple((x is None, str(type(x)), x if not isinstance(x, float)
                                              else round(x, 3)) for x in t))


def _close(a, b):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns[:3] == ["valid_day", "equipment_id", "port_lane"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(key)
    if sql is None:
        pytest.skip("no SQL oracle for this key")
    rel = duck(SF_SMALL).sql(sql)
    o_cols, o_rows = rel.columns, rel.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    for a, b in zip(_sorted_rows(s_cols, s_rows), _sorted_rows(o_cols, o_rows)):
        assert all(_close(x, y) for x, y in zip(a, b)), (a, b)

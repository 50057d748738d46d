"""Incremental operators: high-water marks, new-key filters, keyed upserts
and the affected-day window of the mart.

All are DataFrame transformations; the I/O around them lives in
``lanecast.plans.pipeline``.  High-water marks are scalar subqueries, so
they are evaluated once by Spark and never collected into Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecast.operators.joins import null_aware_anti


def max_of(target: DataFrame, col: str) -> Column:
    """``(SELECT max(col) FROM target)`` as a scalar-subquery Column."""
    return target.select(F.max(col)).scalar()


def newer_than_target(batch: DataFrame, target: DataFrame, col: str) -> DataFrame:
    """Rows of ``batch`` with ``col`` strictly above the target's maximum.
    An empty target has a NULL maximum, which selects nothing."""
    return batch.filter(F.col(col) > max_of(target, col))


def incremental_new_rows(batch_datapoints: DataFrame, raw_datapoints: DataFrame) -> DataFrame:
    """Raw contracts created after the newest one already loaded."""
    return newer_than_target(batch_datapoints, raw_datapoints, "created")


def charges_new_only(batch_charges: DataFrame, raw_charges: DataFrame) -> DataFrame:
    """Charge lines of contracts never seen before
    (``d_id NOT IN (SELECT DISTINCT d_id FROM target)``, NULL-aware)."""
    return null_aware_anti(batch_charges, raw_charges.select("d_id"), "d_id")


def staging_delta(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Raw rows loaded after the staging table's newest load_date."""
    return newer_than_target(raw, staged, "load_date")


def upsert(existing: DataFrame, batch: DataFrame, key: list[str] | str) -> DataFrame:
    """Delete every existing row whose key occurs in ``batch``, then
    insert all of ``batch`` (delete+insert; equals merge for one-row-per-key
    tables and keeps every line for many-rows-per-key tables).  Columns that
    only one side has are kept, NULL on the other (I9).  ``batch`` is read
    twice: pass a stored one."""
    key = [key] if isinstance(key, str) else list(key)
    kept = existing.join(batch.select(*key), key, "left_anti").select(*existing.columns)
    return evolve_schema(kept, batch)


def evolve_schema(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Union with new batch columns appended (old rows get NULL)."""
    return existing.unionByName(batch, allowMissingColumns=True)


def affected_window(datapoints: DataFrame, mart: DataFrame) -> DataFrame:
    """I4: one row (lo, hi) over contracts created after the mart's newest
    ``created``; NULLs when there are none."""
    return window_of(newer_than_target(datapoints, mart, "created"))


def window_of(contracts: DataFrame) -> DataFrame:
    """One row (lo, hi) = min(valid_from), max(valid_to)."""
    return contracts.agg(F.min("valid_from").alias("lo"), F.max("valid_to").alias("hi"))

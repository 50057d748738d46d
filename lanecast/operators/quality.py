"""Declarative data-quality checks, one result row per check:
(check, model, column_name, failures).

Each check is a plain aggregate or anti join: not_null checks of one table
share a single scan (``count_if`` per column), unique counts duplicated
keys, relationships anti-join the distinct parent keys, accepted_values
counts distinct unexpected values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The declared checks of the staging and final models.
NOT_NULL = {
    "charges": ["datapoint_id", "currency"],
    "datapoints": ["datapoint_id", "created", "valid_from", "valid_to", "equipment_id"],
    "exchange_rates": ["exchange_date", "currency"],
    "ports": ["port_id", "code", "slug", "country_code"],
    "regions": ["slug"],
    "daily_lane_equipment_prices": ["valid_day", "equipment_id", "origin_port_id", "destination_port_id"],
}
UNIQUE = {"datapoints": "datapoint_id", "ports": "port_id", "regions": "slug"}
RELATIONSHIPS = [  # (child model, child column, parent model, parent column)
    ("charges", "datapoint_id", "datapoints", "datapoint_id"),
    ("charges", "currency", "exchange_rates", "currency"),
    ("ports", "slug", "ports", "slug"),
]
ACCEPTED_VALUES = [  # (model, column, accepted values)
    ("datapoints", "equipment_id", [1, 2, 3, 4, 5, 6]),
    ("daily_lane_equipment_prices", "equipment_id", [1, 2, 3, 4, 5, 6]),
    ("daily_lane_equipment_prices", "dq_ok", [True, False]),
]


def _row(check: str, model: str, column: str, failures) -> list:
    return [F.lit(check).alias("test_name"), F.lit(model).alias("model"),
            F.lit(column).alias("column_name"), failures.cast("bigint").alias("failures")]


def not_null(model: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """One scan of ``df`` counting NULLs of every column, unpivoted."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.explode(F.array(*[
        F.struct(*_row("not_null", model, c, F.col(c))) for c in columns])).alias("r")).select("r.*")


def unique(model: str, df: DataFrame, column: str) -> DataFrame:
    """Number of non-NULL key values occurring more than once."""
    dup = (df.filter(F.col(column).isNotNull()).groupBy(column).count()
             .filter(F.col("count") > 1))
    return dup.agg(F.count(F.lit(1)).alias("n")).select(*_row("unique", model, column, F.col("n")))


def relationships(child_model: str, child: DataFrame, column: str,
                  parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    orphans = child.filter(F.col(column).isNotNull()).select(column).join(keys, column, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("n")).select(
        *_row("relationships", child_model, column, F.col("n")))


def accepted_values(model: str, df: DataFrame, column: str, values: list) -> DataFrame:
    """Distinct non-NULL values outside the accepted list."""
    bad = df.filter(~F.col(column).isin(values)).select(column).distinct()
    return bad.agg(F.count(F.lit(1)).alias("n")).select(
        *_row("accepted_values", model, column, F.col("n")))


def contract_checks(spark: SparkSession, tables: list[tuple[str, list[str], T.StructType]]) -> DataFrame:
    """C5, schema contracts of stored tables, given as (model, folders of their
    files, contract): one row per model and column, declared or found, with
    the rows stored and, as failures, those in folders where the column is
    missing, undeclared or of another type (at least 1 where there are no
    rows).  Schemas come from the files, not from the readers of the library;
    files of one folder that differ in a type fail to be read."""
    counts = []
    for model, folders, contract in tables:
        want = {f.name: f.dataType for f in contract.fields}
        for folder in folders:
            files = spark.read.option("mergeSchema", "true").parquet(folder)
            got = {f.name: f.dataType for f in files.schema.fields}
            cells = [F.struct(F.lit(c).alias("column_name"), F.lit(got.get(c) != want.get(c)).alias("bad")) for c in [*want, *(got.keys() - want.keys())]]
            counts.append(files.agg(F.count(F.lit(1)).alias("n")).select(F.lit(model).alias("model"), "n", F.explode(F.array(*cells)).alias("c"))
                          .select("model", "c.*", "n"))
    return (_union(counts).groupBy(F.lit("contract").alias("test_name"), "model", "column_name")
            .agg(F.sum("n").alias("rows_checked"), F.sum(F.when(F.col("bad"), F.greatest("n", F.lit(1))).otherwise(0)).alias("failures")))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def run_checks(tables: dict[str, DataFrame], kinds=("not_null", "unique", "relationships",
                                                    "accepted_values")) -> DataFrame:
    """Every declared check over the given models (absent models skipped)."""
    out = []
    if "not_null" in kinds:
        out += [not_null(m, tables[m], cols) for m, cols in NOT_NULL.items() if m in tables]
    if "unique" in kinds:
        out += [unique(m, tables[m], c) for m, c in UNIQUE.items() if m in tables]
    if "relationships" in kinds:
        out += [relationships(cm, tables[cm], cc, tables[pm], pc)
                for cm, cc, pm, pc in RELATIONSHIPS if cm in tables and pm in tables]
    if "accepted_values" in kinds:
        out += [accepted_values(m, tables[m], c, v) for m, c, v in ACCEPTED_VALUES if m in tables]
    return _union(out)

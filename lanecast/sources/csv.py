"""CSV ingestion: scans with explicit schemas, one glob per table, audit
columns, file-to-table naming and per-file row counts.

Input layout (as the source expects it)::

    <input>/full_load/DE_casestudy_{ports,regions,exchange_rates}.csv
    <input>/{full_load,incremental}/DE_casestudy_{datapoints,charges}*.csv

A "file" may also be a folder of part files written by Spark under that
name; ``logical_file`` maps both to the same name.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecast import schemas
from lanecast.functions.compat import as_date, file_stem, table_name_from_file
from lanecast.session import Folder
from lanecast.sources import tables as TB

# File name prefix, the two load folders and the per-table globs.
PREFIX = "DE_casestudy_"
LOAD_DIRS = {"full": "full_load", "incremental": "incremental"}
GLOBS = {
    "ports": "DE_casestudy_ports.csv",
    "regions": "DE_casestudy_regions.csv",
    "exchange_rates": "DE_casestudy_exchange_rates.csv",
    "datapoints": "DE_casestudy_datapoints*.csv",
    "charges": "DE_casestudy_charges*.csv",
}
FULL_ONLY = ("ports", "regions", "exchange_rates")

# An unquoted empty field is NULL, a quoted "" is the empty string: the
# sentinel nullValue keeps Spark from turning "" into NULL as well.
# A value that is not of its column's type fails the scan.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST",
               "enforceSchema": "false", "nullValue": "\u0000"}


def reader(spark: SparkSession, schema):
    r = spark.read.schema(schema)
    for k, v in CSV_OPTIONS.items():
        r = r.option(k, v)
    return r


def logical_file(path: Column) -> Column:
    """'.../X.csv' or '.../X.csv/part-0000.csv' -> 'X.csv'."""
    return F.regexp_extract(path, r"([^/]+\.csv)(/[^/]+)?$", 1)


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files under a glob by their header, names in lower case.  Of each
    file the first line is read, several at a time; files without one are left out."""
    def first_line(file: str) -> tuple[str, ...]:
        line = Folder(spark, file).first_line().removeprefix("\ufeff")
        return tuple(c.strip().lower() for c in next(csv.reader([line]), []))

    files = Folder(spark, path).files()
    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, names in zip(files, pool.map(first_line, files)):
            if names:
                found.setdefault(names, []).append(file)
    return found


def by_name(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The CSV files under a glob, columns found by the names in each file's
    header: one scan for each distinct header.  Columns the schema does not
    know come behind its own, as text, NULL where a file lacks them; a file
    that lacks a column of the schema is an error."""
    groups = headers(spark, path)
    known = schema.fieldNames()
    out = None
    for names, files in sorted(groups.items()):
        missing, repeated = [c for c in known if c not in names], len(set(names)) < len(names)
        if missing or repeated:
            raise ValueError(f"CSV header of {files[0]} {'repeats a name' if repeated else f'lacks {missing}'}")
        kinds = T.StructType([schema[c] if c in known else T.StructField(c, T.StringType()) for c in names])
        source = path if len(groups) == 1 else files
        df = reader(spark, kinds).csv(source).select(*known, *[c for c in names if c not in known])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out if out is not None else reader(spark, schema).csv(path)  # no file at all: Spark's own error


def scan(spark: SparkSession, input_root: str, table: str, load_type: str, load_date,
         file_path: str | None = None) -> DataFrame:
    """One table from its glob, or from ``file_path`` (relative to the
    input root), typed by the raw schema, columns by header name, with the
    audit columns; new source columns come last."""
    if load_date is None:
        raise ValueError("load_date must not be null")
    folder = LOAD_DIRS[load_type] if table not in FULL_ONLY else LOAD_DIRS["full"]
    rel = file_path or f"{folder}/{GLOBS[table]}"
    df = by_name(spark, f"{input_root.rstrip('/')}/{rel}", schemas.RAW[table])
    own = schemas.RAW[table].fieldNames()
    return (df.withColumn("file_path", F.lit(rel))
              .withColumn("load_type", F.lit(folder))
              .withColumn("load_date", as_date(load_date))
              .select(*own, *schemas.AUDIT.fieldNames(), *[c for c in df.columns if c not in own]))


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Every CSV under ``folder`` with its table name and number of
    data rows (header excluded), counted by file before any name is parsed."""
    parts = (spark.read.option("header", "true").csv(f"{folder.rstrip('/')}/*.csv")
             .groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n")))
    return (parts.groupBy(logical_file(F.col("path")).alias("file_name")).agg(F.sum("n").alias("row_count"))
                 .withColumn("table_name", table_name_from_file(file_stem("file_name")))
                 .select("file_name", "table_name", "row_count"))


def load_raw(spark: SparkSession, input_root: str, load_type: str, load_date,
             tables=tuple(GLOBS), file_path: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Files grouped by table, one scan per table.  Full loads
    read every table from ``full_load``; incremental loads read the fact
    tables from ``incremental`` (dimensions stay full)."""
    return {t: scan(spark, input_root, t, load_type, load_date, (file_path or {}).get(t)) for t in tables}


def load_tables(spark: SparkSession, input_root: str, root: str, load_type: str, load_date,
                tables=tuple(GLOBS)) -> None:
    """Write the raw tables below ``root``; a full load replaces them,
    an incremental one appends the fact tables.  A missing folder is an error."""
    folder = f"{input_root.rstrip('/')}/{LOAD_DIRS[load_type]}"
    if not TB.exists(spark, folder):
        raise FileNotFoundError(f"no input folder {folder}")
    for name, df in load_raw(spark, input_root, load_type, load_date, tables).items():
        path = TB.table_path(root, "raw", name)
        if load_type == "full":
            TB.overwrite(df, path)
        elif name not in FULL_ONLY:
            TB.append(df, path)


def write_inputs(spark: SparkSession, batches, input_root: str) -> None:
    """Write raw tables as the CSV layout above (batch 1 -> full_load with
    suffix _1, batch k -> incremental with suffix _k).  Used to build test
    inputs from the driver tables."""
    root = input_root.rstrip("/")
    for i, raw in enumerate(batches, start=1):
        folder = LOAD_DIRS["full"] if i == 1 else LOAD_DIRS["incremental"]
        names = {"datapoints": f"datapoints_{i}", "charges": f"charges_{i}"}
        if i == 1:
            names.update({t: t for t in FULL_ONLY})
        for t, stem in names.items():
            df = getattr(raw, t).select(*schemas.RAW[t].fieldNames())
            # keep padded values (' EUR ') as they are; '' stays a quoted ''
            (df.write.mode("overwrite").option("header", "true").option("emptyValue", '""')
               .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
               .csv(f"{root}/{folder}/{PREFIX}{stem}.csv"))

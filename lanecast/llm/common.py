"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lanecast.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Fixed value: the white space that separates words, \x20 and \x09-\x0D.
# bytes.split() without an argument splits on exactly these six bytes.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
WORD_CLASS = "[^\\x20\\x09-\\x0D]"

_UPPER = bytes(range(65, 91))
LOWER_AZ = bytes.maketrans(_UPPER, _UPPER.lower())

# Rows of an Arrow batch: a batch of the longest texts must fit in a worker.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package and bound their Arrow batches.

    A cluster ships the package with --py-files; for a session started from a
    checkout the folder is added to the workers' PYTHONPATH.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """Text with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{WORD_CLASS}+")).cast("long")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """One output batch per Arrow batch; fn gives the columns by name."""
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cols = fn(b)
                yield pa.record_batch([as_array(cols[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def hash_share(key: Column, wanted: int, rows: int) -> Column:
    """True for about `wanted` of `rows` rows, picked by the hash of a key: a
    bounded sample that is the same in every run and needs no sort."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(min(1 << 30, -(-(wanted << 30) // max(1, rows))))


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def stored(df: DataFrame, *parts: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", *parts)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

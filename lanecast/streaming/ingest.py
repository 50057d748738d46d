"""Incremental raw loads as a Structured Streaming job.

The batch pipeline's raw increment (contracts newer than the loaded
maximum, merged on d_id) becomes a file-source stream over the incremental
folder with ``foreachBatch``.  Each micro-batch applies the same operators
as the batch run, and the write is idempotent (a retried micro-batch finds
its rows no longer newer than the maximum), so a restart after a lost
executor or driver replays safely from the checkpoint.
``trigger(availableNow=True)`` processes whatever has arrived and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecast import schemas
from lanecast.functions.compat import as_date
from lanecast.plans.pipeline import merge_raw_datapoints
from lanecast.sources import csv as CSV


def datapoint_stream(spark: SparkSession, input_root: str, load_date) -> DataFrame:
    """Streaming scan of ``incremental/DE_casestudy_datapoints*.csv`` with
    the raw schema and audit columns."""
    rel = f"{CSV.LOAD_DIRS['incremental']}/{CSV.GLOBS['datapoints']}"
    r = spark.readStream.schema(schemas.RAW_DATAPOINTS)
    for k, v in CSV.CSV_OPTIONS.items():
        r = r.option(k, v)
    return (r.csv(f"{input_root.rstrip('/')}/{rel}")
             .withColumn("file_path", F.lit(rel))
             .withColumn("load_type", F.lit(CSV.LOAD_DIRS["incremental"]))
             .withColumn("load_date", as_date(load_date)))


def upsert_raw_datapoints(target_path: str):
    """foreachBatch sink: newer contracts only, merged on d_id; the table is
    swapped in whole, so a replayed micro-batch finds the old or the new one."""
    def sink(batch: DataFrame, epoch_id: int) -> None:
        merge_raw_datapoints(batch.sparkSession, batch, target_path)
    return sink


def run_datapoint_stream(spark: SparkSession, input_root: str, target_path: str,
                         checkpoint_location: str, load_date) -> None:
    """Process every file that has arrived, then stop."""
    q = (datapoint_stream(spark, input_root, load_date).writeStream
         .foreachBatch(upsert_raw_datapoints(target_path))
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()

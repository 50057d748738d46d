"""Coverage snapshots (I6) and the before/after change view."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanecast import schemas
from lanecast.functions.compat import duck_round


def coverage_snapshot(mart: DataFrame, stage: str, snapshot_ts) -> DataFrame:
    """One row: (snapshot_ts, stage, number of covered lane-days).  The
    timestamp is passed in (the source uses current_timestamp)."""
    ts = F.lit(str(snapshot_ts)).cast("timestamp_ntz")
    out = (mart.filter(F.col("dq_ok") == F.lit(True))
               .agg(F.count(F.lit(1)).alias("covered_lane_count"))
               .select(ts.alias("snapshot_ts"), F.lit(stage).alias("stage"), "covered_lane_count"))
    return out.select([F.col(f.name).cast(f.dataType) for f in schemas.COVERAGE.fields])


def coverage_changes(log: DataFrame) -> DataFrame:
    """Pair each 'before' snapshot with the first 'after' snapshot strictly
    later (forward as-of join), then diff and percent change (NULL when the
    before count is 0 or NULL).  A 'before' without a later 'after' has no
    row; befores sharing one timestamp yield one row (larger count kept).

    No pair enumeration: one pass over each calendar month in descending time
    carries the last 'after' it has seen (a running frame, linear in the month);
    befores with none left in their month take the first 'after' of the next
    month that has one, from a table of one row per month."""
    t = F.unix_micros(F.col("snapshot_ts").cast("timestamp"))
    n = F.col("covered_lane_count")
    rows = log.select("snapshot_ts", "stage", "covered_lane_count",
                      t.alias("_t"), F.trunc("snapshot_ts", "month").alias("_m"))
    is_after = F.coalesce(F.col("stage") == "after", F.lit(False))
    after = F.when(is_after, F.struct(F.col("_t"), F.col("snapshot_ts").alias("ts"), n.alias("n")))
    # at one time befores come first, so they do not see its afters; of several
    # afters at one time the smallest is seen last
    later = (Window.partitionBy("_m").orderBy(F.col("_t").desc(), is_after, n.desc_nulls_last())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    paired = rows.withColumn("_next", F.last(after, ignorenulls=True).over(later)).filter(F.col("stage") == "before")

    # each month with an 'after' serves the months back to the one before it that has one
    months = rows.groupBy("_m").agg(F.min(after).alias("_first"))
    firsts = F.collect_list(F.when(F.col("_first").isNotNull(), F.struct("_m", "_first")))  # one entry a month
    lists = months.agg(F.min("_m").alias("lo"), F.sort_array(firsts).alias("l"))
    spans = lists.select("lo", F.posexplode("l").alias("i", "x"), F.transform("l", lambda x: x["_m"]).alias("ms")).select(
        F.explode(F.sequence(F.coalesce(F.get("ms", F.col("i") - 1), F.least("lo", F.add_months("x._m", -1))),
                             F.add_months("x._m", -1), F.expr("INTERVAL 1 MONTH"))).alias("_m"), "x._first")
    paired = paired.join(spans, "_m", "left")
    carried = F.col("_first")
    paired = (paired.withColumn("_a", F.when(F.col("_next").isNotNull(), F.col("_next")).otherwise(carried))
                    .filter(F.col("_a").isNotNull()))
    one = (paired.groupBy("snapshot_ts")
                 .agg(F.max_by("_a", "covered_lane_count").alias("_a"),
                      F.max("covered_lane_count").alias("before_count")))
    before, after_n = F.col("before_count"), F.col("_a.n")
    pct = F.when(before.isNull() | (before == 0), F.lit(None).cast("double")) \
           .otherwise(duck_round((after_n - before).cast("double") * 100.0 / before.cast("double")))
    return (one.select(F.col("snapshot_ts").alias("before_ts"), F.col("_a.ts").alias("after_ts"),
                       "before_count", after_n.alias("after_count"),
                       (after_n - before).alias("diff_count"), pct.alias("pct_change"))
               .orderBy("after_ts"))

"""Connected components of a distributed edge list by alternating large-star
and small-star rounds.

A round gives every node's larger neighbours (then: smaller neighbours) the
smallest node it knows; it never needs a node's neighbours in one task, and
the number of rounds is about the logarithm of the longest path.  Each round
ends in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) of every node that is not
    its own root; edges: a, b (bigint).  Loops and nulls link nothing."""
    e = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    last = None
    while (now := _signature(e)) != last:
        last = now
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select("v", "u"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.union(least).distinct(), "cc")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _signature(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

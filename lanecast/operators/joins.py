"""Join helpers.

Broadcasts are left to the planner: it broadcasts a side only below
``spark.sql.autoBroadcastJoinThreshold`` bytes, by the sizes of the stored
tables or, at run time, of finished shuffle stages; beyond it joins are
sort-merge joins whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_aware_anti(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left WHERE key NOT IN (SELECT key FROM right)`` with SQL NULL
    semantics: a NULL key on the right blocks every row, a NULL key on the
    left never passes.  The right side is first reduced to the keys of the
    left one, so a long history is never shuffled against a small batch; the
    NULL test reads only row groups that hold NULLs."""
    nulls = right.filter(F.col(key).isNull()).agg(F.count(F.lit(1))).scalar()
    mine = left.filter(F.col(key).isNotNull())
    seen = right.select(key).join(mine.select(key).distinct(), key, "left_semi")
    return mine.join(seen, key, "left_anti").filter(nulls == 0)

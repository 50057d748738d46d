"""Exact top-k search with vector-approximation files.

Vectors are dealt into blocks by a hash of their id.  A block keeps, beside
its exact vectors, a vector-approximation file: one byte per component, the
cell of the component between quantiles of the block.  For a query the scan of
the cells gives each vector an upper bound of its inner product (the best
corner of its cell); exact vectors are then read in the order of the bound
until the kth score found is above every bound not read.  Each block answers
for each query; the answers' best k are the result.

Queries are a stated set and are sent to every block in groups, so a task
holds one block and one group of queries, never all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Search:
    """k results; a query is a row whose id is divisible by `every`; rows of a
    block and of a group of queries (about); cells per component."""

    k: int = 5
    every: int = 50
    block_rows: int = 4096
    query_rows: int = 1024
    cells: int = 64


def quantised(vector: str) -> Column:
    """floor(256 * x) of every component as bigint; null if the vector or a
    component is null or not finite."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(F.col(vector).isNotNull() & ~bad, F.transform(x, lambda c: F.floor(c * 256.0).cast("bigint")))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers as int64, short vectors filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


class VAFile:
    """Cells of a block and the least and largest component in each."""

    def __init__(self, x: np.ndarray, cells: int):
        self.x = x
        edges = np.quantile(x, np.linspace(0, 1, cells + 1)[1:-1], axis=0) if len(x) else np.zeros((cells - 1, x.shape[1]))
        self.codes = np.stack([np.searchsorted(edges[:, d], x[:, d], "right") for d in range(x.shape[1])], axis=1).astype(np.uint8) \
            if x.shape[1] else np.zeros((len(x), 0), dtype=np.uint8)
        self.low = np.full((cells, x.shape[1]), np.inf)
        self.high = np.full((cells, x.shape[1]), -np.inf)
        dims = np.broadcast_to(np.arange(x.shape[1]), x.shape)
        np.minimum.at(self.low, (self.codes, dims), x)
        np.maximum.at(self.high, (self.codes, dims), x)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product of each query with each vector."""
        dims = np.arange(self.x.shape[1])
        low, high = self.low[self.codes, dims], self.high[self.codes, dims]
        return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T

    def top(self, q: np.ndarray, bound: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) for a query, ties to the smaller id."""
        order = np.argsort(-bound, kind="stable")
        best: list[tuple[int, int]] = []
        at, step = 0, 32
        while at < len(order) and (len(best) < k or bound[order[at]] >= best[-1][0]):
            part = order[at:at + step]
            part = part[ids[part] != own]
            scores = self.x[part] @ q
            best = sorted([*best, *zip(scores.tolist(), ids[part].tolist())], key=lambda s: (-s[0], s[1]))[:k]
            at, step = at + step, step * 2
        return best


def top_k(rows: DataFrame, search: Search = Search(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every query its k best rows
    other than itself, ties to the smaller id.

    Vectors that are null or hold null or non-finite components take no part,
    nor do rows without an id.  Rows that repeat an id are one, the one with
    the smallest vector.  Vectors of different lengths are compared as if the
    shorter went on with zeros.  An empty table gives no rows; a lone row has
    no results.  Scores must fit a bigint.
    """
    v = (rows.select(F.col(id_col).cast("bigint").alias("id"), quantised(vector_col).alias("v"))
         .filter("id is not null and v is not null").groupBy("id").agg(F.min("v").alias("v")))
    is_query = F.col("id") % search.every == 0
    n, queries, width = v.agg(F.count("id"), F.count(F.when(is_query, 1)), F.max(F.size("v"))).first()
    blocks, groups, width = max(1, -(-n // search.block_rows)), max(1, -(-queries // search.query_rows)), width or 0
    place = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")
    group = F.pmod(F.xxhash64("id", F.lit("q")), F.lit(groups)).alias("grp")
    every_block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block")
    every_group = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("grp")
    stored_side = v.select("id", "v", place, every_group)
    query_side = v.filter(is_query).select("id", "v", group, every_block)

    def answer(x: pa.Table, q: pa.Table) -> pa.Table:
        out = []
        if x.num_rows and q.num_rows:
            ids = x["id"].to_numpy()
            va = VAFile(matrix(x["v"], width), search.cells)
            qs = matrix(q["v"], width)
            for i in range(0, len(qs), 64):
                bound = va.bounds(qs[i:i + 64].astype(float))
                for j, own in enumerate(q["id"].to_pylist()[i:i + 64]):
                    out += [(own, vec, score) for score, vec in va.top(qs[i + j], bound[j], ids, own, search.k)]
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), cols)})

    found = (stored_side.groupBy("block", "grp").cogroup(query_side.groupBy("block", "grp"))
             .applyInArrow(answer, "query_id bigint, vec_id bigint, score bigint"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= search.k)
            .select("query_id", "rank", "vec_id", "score"))

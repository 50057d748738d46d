"""SimHash near-duplicates with vantage-point trees.

A fingerprint is the bitwise majority of the 64-bit hashes of a text's word
shingles.  Two fingerprints within r bits are, in one of the two 32-bit halves,
within r // 2 bits; so each half gets a vantage-point tree over the Hamming
distance of that half.  A tree, built from a bounded sample of the distinct
fingerprints, splits by distance to a vantage point at a radius mu and cuts the
space into shards.  A fingerprint lives in one shard of each tree and visits
those shards that its ball of radius r // 2 may reach: inside if d - r//2 <= mu,
outside if d + r//2 > mu; the triangle bound rules out the others.  A shard
splits itself further the same way, then compares all 64 bits exactly.

A shard reports its links as one edge per fingerprint to a representative, so
a group of copies never becomes all its pairs; components of the edges are
found by distributed rounds.  Equal fingerprints are one node from the start.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.llm.common import LOWER_AZ, hash_share, map_batches, stored, text_of
from lanecast.llm.components import components

# Fixed value: seed of the shingle hash.
SEED = 42
HALVES = (np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000))


@dataclass(frozen=True)
class Near:
    """shingle words, largest bit distance, fingerprints of a shard (about),
    most sampled fingerprints (about) the driver builds a tree from (8 bytes each)."""

    words: int = 3
    bits: int = 3
    shard_rows: int = 2000
    most_sampled: int = 1 << 20


def fingerprint(text: str, size: int = 3) -> int:
    """Majority fingerprint of a text, as a signed 64-bit number."""
    words = text.encode().translate(LOWER_AZ).split()
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= size:
        h = np.array([xxhash.xxh64_intdigest(whole, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-size])).tolist()
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())),
                        dtype=np.uint64, count=len(starts))
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, text_hash and fp (bigint) of every row; null text is empty, fingerprint 0."""
    def run(b: pa.RecordBatch) -> dict:
        return {id_col: b.column(0), "text_hash": b.column(1),
                "fp": [fingerprint(t, near.words) for t in b.column(2).to_pylist()]}

    kind = docs.schema[id_col].dataType.simpleString()
    text = text_of(text_col)
    return map_batches(docs.select(id_col, F.xxhash64(text).alias("text_hash"), text.alias("text")), run,
                       f"`{id_col}` {kind}, text_hash bigint, fp bigint")


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def _split(points: np.ndarray, reach: int, rng: np.random.Generator) -> tuple | None:
    """Vantage point and radius that cut points in two with least overlap."""
    best = None
    for v in points[rng.choice(len(points), min(12, len(points)), replace=False)]:
        d = np.sort(_distance(points, v))
        for mu in {int(d[len(d) * q // 8]) for q in (3, 4, 5)}:
            inside = int(np.searchsorted(d, mu, "right"))
            if not len(d) // 8 < inside < len(d) - len(d) // 8:
                continue
            both = int(np.searchsorted(d, mu + reach, "right") - np.searchsorted(d, mu - reach, "right"))
            if best is None or both < best[0]:
                best = (both, v, mu)
    return best and best[1:]


def build_tree(sample: np.ndarray, leaves: int, reach: int) -> list[tuple]:
    """Nodes (vantage, mu, inside, outside); a leaf is (None, shard, -1, -1)."""
    rng, nodes, shards = np.random.default_rng(0), [], 0
    todo = [(sample, leaves, -1, 0)]
    while todo:
        points, share, parent, side = todo.pop()
        at = len(nodes)
        if parent >= 0:
            nodes[parent][2 + side] = at
        cut = _split(points, reach, rng) if share > 1 and len(points) >= 8 else None
        if cut is None:
            nodes.append([None, shards, -1, -1])
            shards += 1
            continue
        nodes.append([*cut, -1, -1])
        inside = _distance(points, cut[0]) <= cut[1]
        part = inside.mean()
        todo += [(points[inside], share * part, at, 0), (points[~inside], share * (1 - part), at, 1)]
    return [tuple(n) for n in nodes]


def route(nodes: list[tuple], points: np.ndarray, reach: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, rows, whether the row lives there) for each shard a row visits."""
    out, todo = [], [(0, np.arange(len(points)), np.ones(len(points), dtype=bool))]
    while todo:
        at, rows, home = todo.pop()
        vantage, mu, inside, outside = nodes[at]
        if vantage is None:
            out.append((mu, rows, home))
            continue
        d = _distance(points[rows], vantage)
        for child, reaches, lives in ((inside, d - reach <= mu, d <= mu), (outside, d + reach > mu, d > mu)):
            if reaches.any():
                todo.append((child, rows[reaches], (home & lives)[reaches]))
    return out


def links_within(points: np.ndarray, home: np.ndarray, mask: np.uint64, bits: int, reach: int) -> np.ndarray:
    """For each point of a shard, the index of its representative: points that
    chains of links between a resident and a visitor join have the same one."""
    parent = np.arange(len(points))
    rng = np.random.default_rng(0)
    half = points & mask
    todo = [(np.flatnonzero(home), np.arange(len(points)))]
    while todo:
        mine, all_ = todo.pop()
        if len(mine) > 256 and (cut := _split(half[mine], reach, rng)) is not None:
            m, a = _distance(half[mine], cut[0]), _distance(half[all_], cut[0])
            todo += [(mine[m <= cut[1]], all_[a - reach <= cut[1]]), (mine[m > cut[1]], all_[a + reach > cut[1]])]
            continue
        for a, b in _close(points, mine, all_, bits):
            _join(parent, a, b)
    return parent


def _close(points: np.ndarray, mine: np.ndarray, all_: np.ndarray, bits: int):
    """Residents and visitors within `bits`, block by block.  Many residents that
    no vantage point tells apart (equal in their half) are compared by bytes of
    the whole fingerprint: of any bits + 1 bytes two such points share one, so
    those with the most different values are taken."""
    groups = [(mine, all_)]
    if len(mine) > 256 and bits < 8:
        a, b = (points[i].view(np.uint8).reshape(-1, 8) for i in (mine, all_))
        alike = [float(np.bincount(a[:, j], minlength=256) @ np.bincount(b[:, j], minlength=256)) for j in range(8)]
        groups = ((mine[a[:, j] == v], all_[b[:, j] == v])
                  for j in np.argsort(alike, kind="stable")[:bits + 1] for v in np.unique(a[:, j]))
    for some, others in groups:
        for i in range(0, len(some), 64):
            for k in range(0, len(others), 1 << 16):
                x, y = some[i:i + 64], others[k:k + (1 << 16)]
                r, c = np.nonzero(np.bitwise_count(points[x][:, None] ^ points[y][None, :]) <= bits)
                yield x[r], y[c]


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        a, b = parent[a], parent[b]
        a, b = a[a != b], b[a != b]
        low = np.minimum(a, b)
        np.minimum.at(parent, a, low)
        np.minimum.at(parent, b, low)
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up


def edges(distinct: DataFrame, near: Near = Near()) -> DataFrame:
    """a, b: fingerprints linked in some shard, each to one representative.

    distinct: fp, one row per fingerprint.  The driver holds a sample of about
    near.most_sampled fingerprints at most and the trees built from it.
    """
    spark, reach = distinct.sparkSession, near.bits // 2
    n = distinct.count()
    leaves = max(1, -(-n // near.shard_rows))
    sample = distinct.filter(hash_share(F.col("fp"), min(near.most_sampled, 32 * leaves), n)).orderBy("fp")
    points = np.array([r.fp for r in sample.toLocalIterator()], dtype=np.int64).view(np.uint64)
    shipped = spark.sparkContext.broadcast([build_tree(np.unique(points & m), leaves, reach) for m in HALVES])

    def place(b: pa.RecordBatch) -> dict:
        fp = b.column(0).to_numpy()
        p = fp.view(np.uint64)
        got = [(2 * s + t, fp[rows], home) for t, m in enumerate(HALVES)
               for s, rows, home in route(shipped.value[t], p & m, reach)]
        return {"shard": np.concatenate([np.full(len(x), s) for s, x, _ in got]),
                "fp": np.concatenate([x for _, x, _ in got]), "home": np.concatenate([h for *_, h in got])}

    def compare(t: pa.Table) -> pa.Table:
        fp = np.ascontiguousarray(t["fp"].to_numpy())
        home = t["home"].to_numpy(zero_copy_only=False)
        mask = HALVES[t["shard"][0].as_py() % 2]
        root = links_within(fp.view(np.uint64), home, mask, near.bits, reach)
        linked = root != np.arange(len(fp))
        return pa.table({"a": pa.array(fp[linked]), "b": pa.array(fp[root[linked]])})

    placed = map_batches(distinct.select("fp"), place, "shard bigint, fp bigint, home boolean")
    return placed.groupBy("shard").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, text_hash, fp and component_id: one row per input row.

    Empty and null texts have fingerprint zero and are linked like any other;
    a null id is no candidate for the smallest id (component_id is null only
    if all ids of a component are); repeated rows give repeated rows; an empty
    table gives no rows; other columns are not looked at.
    """
    fps = stored(fingerprints(docs, near, id_col, text_col), "simhash")
    distinct = stored(fps.groupBy("fp").agg(F.min(id_col).alias("first")), "simhash")
    roots = components(stored(edges(distinct, near), "simhash"))
    named = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
             .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(named.join(smallest, "root").select("fp", "component_id"), "fp").select(
        id_col, "text_hash", "fp", "component_id")


def deduplicate(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of docs with the smallest id of each component, one for each id
    and text; all its columns."""
    kept = (near_duplicates(docs, near, id_col, text_col).filter(F.col(id_col).eqNullSafe(F.col("component_id")))
            .groupBy(F.col("component_id").alias("__sim_id")).agg(F.min("text_hash").alias("__sim_hash")))
    d = docs.withColumn("__sim_text", F.xxhash64(text_of(text_col)))
    return (d.join(kept, F.col(id_col).eqNullSafe(F.col("__sim_id")) & (F.col("__sim_text") == F.col("__sim_hash")))
            .dropDuplicates([id_col]).select(*docs.columns))


def as_hex(fp: str):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

"""Merkle dataset manifest: a tree over each group of rows and one over the groups.

A level is a table of nodes (group, index, digest).  It is joined with itself
on computed sibling indices (for a binary tree the index XOR 1, else the
offsets of the other slots), which puts beside every node the digests of its
run; the rows of slot zero then hold a whole run and emit its parent.  Levels
are written one by one, so a lost executor costs part of one level.

Proofs come back down the same levels: a node's path is the digests beside it,
then the path of its parent.  Rows halve with each level upwards; the greatest
size of a group and the root are all that comes to the driver.

Leaves get their index from a range-partitioned order: a group is a run in each
of a few partitions, and the counts of those runs place them.  No group is
sorted or counted in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanecast.llm.common import stored

ABSENT = "-"  # fixed value: what stands for a null in a leaf
NO_PATH = "array<struct<before:string,after:string>>"


@dataclass(frozen=True)
class Manifest:
    """group: rows of one value are one tree, ascending by `order`; fields:
    what a leaf hashes, in this order; arity: nodes of one parent."""

    group: str = "lang"
    order: str = "doc_id"
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")
    arity: int = 2


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(*fields: Column) -> Column:
    """Each value as its UTF-8 length, a colon and itself, a null as ABSENT."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit(ABSENT)) for t in texts])


def in_order(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Stored `rows` in (group, order), each with its place `_at`, and the runs
    of the groups: group, _part, _first, _before (rows of the group in earlier
    partitions), _rows.  Rows equal in `order` are told apart by where they are
    stored, so that any number of them shares out over the partitions."""
    by = [group, *order, "_row"]
    ranged = stored(rows.withColumn("_row", F.monotonically_increasing_id())
                    .repartitionByRange(*by).sortWithinPartitions(*by).drop("_row")
                    .withColumn("_at", F.monotonically_increasing_id()), "merkle", "ranged")
    runs = ranged.groupBy(group, partition_of("_at").alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return ranged, stored(runs.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))), "merkle", "runs")


def partition_of(place: str) -> Column:
    return F.shiftright(place, 33)  # monotonically_increasing_id: partition, then 33 bits of row


def indexed(ranged: DataFrame, runs: DataFrame, group: str) -> DataFrame:
    """The rows with `idx` in their group and all further columns of their run.
    No key of this join has more rows than one range partition."""
    at = runs.drop("_rows").withColumnRenamed(group, "_group")
    on = (partition_of("_at") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group"))
    return (ranged.join(at, on).withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_at", "_part", "_first", "_before", "_group"))


def beside(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with the joined digests `before` and `after` them in their run."""
    slot = F.col("idx") % arity
    if arity == 2:
        siblings = [F.col("idx").bitwiseXOR(F.lit(1))]
    else:
        siblings = [F.col("idx") - slot + (slot + d) % arity for d in range(1, arity)]
    out = nodes
    for d, at in enumerate(siblings, 1):
        other = nodes.select(F.col("gid").alias("_gid"), F.col("idx").alias("_idx"), F.col("h").alias(f"_h{d}"))
        out = out.join(other, (F.col("gid") == F.col("_gid")) & (at == F.col("_idx")), "left").drop("_gid", "_idx")
    beside_me = F.array(*[F.col(f"_h{d}") for d in range(1, arity)])
    in_slot = [F.get(beside_me, ((F.lit(j) - slot + arity) % arity - 1).cast("int")) for j in range(arity)]
    return (out.withColumn("before", F.concat_ws("", *[F.when(F.lit(j) < slot, in_slot[j]) for j in range(arity)]))
            .withColumn("after", F.concat_ws("", *[F.when(F.lit(j) > slot, in_slot[j]) for j in range(arity)]))
            .drop(*[f"_h{d}" for d in range(1, arity)]))


def build(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """From leaves (gid, idx, n: nodes of the group, h, ...) the levels, each
    with before and after, and the roots: gid, level, root.  A group of one
    node has reached its root and is in no further level."""
    levels, roots, most = [], [], nodes.agg(F.max("n")).first()[0] or 0
    while most >= 1:
        roots.append(nodes.filter("n = 1").select("gid", F.lit(len(levels)).alias("level"), F.col("h").alias("root")))
        if most == 1:
            break
        levels.append(stored(beside(nodes.filter("n > 1"), arity), "merkle", "level"))
        nodes = levels[-1].filter(F.col("idx") % arity == 0).select(
            "gid", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            digest(F.col("h"), F.col("after")).alias("h"))
        most = -(-most // arity)
    if not roots:
        return [], nodes.select("gid", F.lit(0).alias("level"), F.col("h").alias("root"))
    union = roots[0]
    for r in roots[1:]:
        union = union.unionByName(r)
    return levels, stored(union, "merkle", "roots")


def paths(leaves: DataFrame, levels: list[DataFrame], roots: DataFrame, arity: int) -> DataFrame:
    """Leaves with the root of their group and their path: the digests before
    and after the node on each level, from the leaf up.  `roots` may bring a
    path of their own, which goes on from there."""
    top = roots if "path" in roots.columns else roots.withColumn("path", F.array().cast(NO_PATH))
    above = None
    for at in reversed(range(len(levels))):
        starts = top.filter(F.col("level") == at + 1).select("gid", F.lit(0).cast("bigint").alias("idx"), "root", "path")
        parents = starts if above is None else above.unionByName(starts)
        parents = parents.select(F.col("gid").alias("_gid"), F.col("idx").alias("_idx"), "root", F.col("path").alias("_path"))
        here = (levels[at].join(parents, (F.col("gid") == F.col("_gid")) & (F.expr(f"idx div {arity}") == F.col("_idx")))
                .withColumn("path", F.concat(F.array(F.struct("before", "after")), "_path")))
        above = stored(here.select("gid", "idx", "root", "path"), "merkle", "paths") if at else here
    alone = (leaves.filter("n = 1").join(top.filter("level = 0").select(F.col("gid").alias("_gid"), "root", "path"),
                                         F.col("gid") == F.col("_gid")))
    names = [*leaves.columns, "root", "path"]
    return alone.select(*names) if above is None else above.select(*names).unionByName(alone.select(*names))


def manifest(docs: DataFrame, presented: Column | None = None, m: Manifest = Manifest()) -> DataFrame:
    """`order`, leaf, presented, subroot, root, path: one row per row of docs.

    `presented` is the digest to be held against the manifest (by default the
    leaf).  Rows that repeat an order value stand by their leaf digest; equal
    rows are leaves of their own, with proofs of their own.  A null group is
    the first group, a null order value comes first in its group, a null field
    is `-`; a group or table of one row is its own root, with an empty path.
    An empty table gives no rows; columns that are no field are not looked at.
    """
    leaf = leaf_digest(*[F.col(c) for c in m.fields])
    rows = stored(docs.select(F.col(m.group).alias("grp"), F.col(m.order).alias("key"), leaf.alias("h"),
                              (leaf if presented is None else presented).alias("presented")), "merkle", "leaves")
    ranged, runs = in_order(rows, "grp", ["key", "h"])
    sizes = stored(runs.groupBy("grp").agg(F.sum("_rows").alias("n")).withColumn("all", F.lit(0)), "merkle", "groups")
    groups = indexed(*in_order(sizes, "all", ["grp"]), "all").select(F.col("grp").alias("_name"), F.col("idx").alias("gid"), "n")
    # one row per group and partition
    runs = runs.join(groups, F.col("grp").eqNullSafe(F.col("_name"))).drop("_name")
    leaves = stored(indexed(ranged, runs, "grp").select("gid", "idx", "n", "h", "key", "presented"), "merkle", "indexed")

    levels, subroots = build(leaves, m.arity)
    count = subroots.count()
    tops = subroots.select(F.lit(0).cast("bigint").alias("gid"), F.col("gid").alias("idx"), F.lit(count).cast("bigint").alias("n"),
                           F.col("root").alias("h"), F.col("level").alias("height"))
    top_levels, top_root = build(tops, m.arity)
    root = top_root.first()
    above = paths(tops, top_levels, top_root, m.arity).select(
        F.col("idx").alias("gid"), F.col("height").alias("level"), F.col("h").alias("root"), "path")
    out = paths(leaves, levels, stored(above, "merkle", "tops"), m.arity)
    return out.select(F.col("key").alias(m.order), F.col("h").alias("leaf"), "presented", F.col("root").alias("subroot"),
                      F.lit(root["root"] if root else None).cast("string").alias("root"), "path")


def proof_digest(path: str = "path") -> Column:
    """One digest over all digests of a path, from the leaf up."""
    return digest(F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["after"]))))


def folded(leaf: str = "presented", path: str = "path") -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, F.col(leaf), lambda acc, s: digest(s["before"], acc, s["after"]))


def checked(docs: DataFrame, m: Manifest = Manifest(), counter: str = "n_chars", one_in: int = 7) -> DataFrame:
    """`order`, leaf, subroot, root, proof_sha256, folded_root, verified, where
    one row in `one_in` (by the CRC-32 of its key) presents a `counter` raised
    by one; a null counter stays, and so does a row without a key."""
    hit = F.coalesce(F.crc32(F.col(m.order).cast("string").cast("binary")) % one_in == 0, F.lit(False))
    raised = [F.col(c) + 1 if c == counter else F.col(c) for c in m.fields]
    tampered = F.when(hit & F.col(counter).isNotNull(), leaf_digest(*raised)).otherwise(leaf_digest(*[F.col(c) for c in m.fields]))
    rows = manifest(docs, tampered, m)
    out = rows.withColumn("proof_sha256", proof_digest()).withColumn("folded_root", folded())
    return out.select(m.order, "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))

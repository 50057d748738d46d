"""Layer tables: immutable segments of Parquet files and one manifest per version.

``<root>/<layer>/<table>/_seg=<id>/...`` holds what one write has made,
``<table>/_versions/<n>.json`` names the segments of version n.  A write makes a
segment nobody reads yet; the table changes when its manifest is renamed into
place, and a run lost at any earlier point leaves the version before it whole.
So a batch writes its own rows and nothing twice:

* ``overwrite`` names only the new segment;
* ``append`` adds one;
* ``upsert`` adds one, and the keys it shares with older segments as a small
  folder ``_del=<id>`` that readers take out of those segments;
* ``replace_partitions`` adds one and takes its partitions out of older ones.

The manifest also keeps the table's schema (columns are only ever added), the
rows and the greatest values of `MARKS` of every segment and partition, from
which high-water marks are read without touching the data, and the ids of the
runs that were committed, which make a repeated append a no-op.  After
`MAX_SEGMENTS` writes a table is rewritten as one segment.

One writer a table at a time; renames of files must be atomic, as they are in
the file systems Spark's own commits rely on.  Folders that neither this version
nor the one before it names are removed by the next commit, so a reader may
still finish while one write goes by.  A plain Parquet folder is read as it is and
becomes a versioned table with its first append or upsert.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecast.session import Folder, scratch_path

MARKS = ("created", "load_date", "rollup_source")  # columns whose greatest value is kept, where a table has them
TEXT_MARKS = ("rollup_source",)  # kept as they are
MAX_SEGMENTS = 24
SEG, DEL = "_seg", "_del"


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


# ---- manifests ----------------------------------------------------------------


@dataclass
class Manifest:
    """A version.  segments: id, stats [{part, rows, marks}] and gone (its
    partitions that later segments replaced), oldest first; deletes: id, key and
    the segments (ids) whose rows with such keys are gone."""

    version: int = 0
    schema: dict | None = None
    partition_by: list[str] = field(default_factory=list)
    segments: list[dict] = field(default_factory=list)
    deletes: list[dict] = field(default_factory=list)
    runs: list[str] = field(default_factory=list)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)

    def folders(self) -> set[str]:
        return {f"{SEG}={s['id']}" for s in self.segments} | {f"{DEL}={d['id']}" for d in self.deletes}

    def stats(self) -> list[dict]:
        return [x for s in self.segments for x in s["stats"] if x["part"] not in s["gone"]]


def _versions(path: str) -> str:
    return f"{path}/_versions"


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest version; None for a missing table or a plain folder."""
    names = [n for n in Folder(spark, _versions(path)).names() if n.endswith(".json")]
    if not names:
        return None
    return Manifest(**json.loads(Folder(spark, f"{_versions(path)}/{max(names)}").read_text()))


def _commit(spark: SparkSession, path: str, old: Manifest | None, new: Manifest) -> None:
    new.version = (old.version if old else 0) + 1
    name = f"{_versions(path)}/{new.version:09d}"
    Folder(spark, f"{name}.tmp").write_text(json.dumps(new.__dict__))
    Folder(spark, f"{name}.tmp").rename(Folder(spark, f"{name}.json"))
    keep = new.folders() | (old.folders() if old else set())
    for child in Folder(spark, path).names():
        if child.startswith((f"{SEG}=", f"{DEL}=")) and child not in keep:
            Folder(spark, f"{path}/{child}").delete()
    for child in Folder(spark, _versions(path)).names():
        if child < f"{new.version - 1:09d}":
            Folder(spark, f"{_versions(path)}/{child}").delete()


# ---- reading --------------------------------------------------------------------


def exists(spark: SparkSession, path: str) -> bool:
    """True when there is a table (or any folder) at ``path``, readable or not."""
    return manifest(spark, path) is not None or (Folder(spark, path).exists() and not Folder(spark, _versions(path)).exists())


def read(spark: SparkSession, path: str, schema: T.StructType | None = None,
         newer: tuple[str, str | None] | None = None) -> DataFrame:
    """The newest version of the table.  ``newer`` = (mark column, value) leaves
    out whole segments without a greater value (a None leaves out all); rows of
    the others are the caller's to filter."""
    m = manifest(spark, path)
    if m is None:
        return (spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")).parquet(path)
    want = schema if schema is not None else m.struct()
    segments = [s for s in m.segments if newer is None or any(_above(x["marks"].get(newer[0]), newer[1]) for x in s["stats"])]
    if not segments:
        return spark.createDataFrame([], want)
    table, names = m.struct(), want.fieldNames()
    hidden = sorted({k for d in m.deletes for k in d["key"]} | set(m.partition_by) - set(names))
    df = _raw(spark, path, SEG, [s["id"] for s in segments], T.StructType([*want.fields, *[table[k] for k in hidden if k not in names]]))
    for s in segments:
        if s["gone"]:
            df = df.filter(~((F.col(SEG) == s["id"]) & _part(m.partition_by).isin(s["gone"])))
    for d in m.deletes:
        if not any(s["id"] in d["segments"] for s in segments):
            continue
        keys = _raw(spark, path, DEL, [d["id"]], T.StructType([table[k] for k in d["key"]])).drop(DEL)
        keys = keys.withColumnsRenamed({k: f"{DEL}_{k}" for k in d["key"]})
        same = F.col(SEG).isin(d["segments"])
        for k in d["key"]:
            same = same & (F.col(k) == F.col(f"{DEL}_{k}"))
        df = df.join(keys, same, "left_anti")
    return df.select(names)


def _part(partition_by: list[str]) -> Column:
    """The text a partition is named by in the manifest."""
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in partition_by])


def _raw(spark: SparkSession, path: str, kind: str, ids: list[str], want: T.StructType) -> DataFrame:
    """The files of some segments, their id as a partition column."""
    stored = T.StructType([*want.fields, T.StructField(kind, T.StringType())])
    return spark.read.schema(stored).option("basePath", path).parquet(*[f"{path}/{kind}={i}" for i in ids])


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """The table with every column any of its segments has."""
    return read(spark, path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame of ``schema`` when it does not exist yet
    (``create table if not exists``)."""
    return read(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def segment_paths(spark: SparkSession, path: str) -> list[str]:
    """Folders of the segments of the newest version (at most `MAX_SEGMENTS`)."""
    m = manifest(spark, path)
    return [path] if m is None else [f"{path}/{SEG}={s['id']}" for s in m.segments]


def partition_segments(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """What each partition of the newest version is made of: its segments and
    the deletes that apply to them."""
    m, out = manifest(spark, path) or Manifest(), {}
    for s in m.segments:
        made_of = [s["id"], *[d["id"] for d in m.deletes if s["id"] in d["segments"]]]
        for x in s["stats"]:
            if x["part"] not in s["gone"]:
                out.setdefault(x["part"], []).extend(made_of)
    return out


def partition_marks(spark: SparkSession, path: str, col: str) -> dict[str, str | None]:
    """The greatest ``col`` of each partition, from the manifest; empty without a table."""
    m, out = manifest(spark, path) or Manifest(), {}
    for x in m.stats():
        out[x["part"]] = max(filter(None, (out.get(x["part"]), x["marks"].get(col))), default=None)
    return out


def _above(value: str | None, limit: str | None) -> bool:
    return value is not None and limit is not None and value > limit


def mark(spark: SparkSession, path: str, col: str) -> str | None:
    """The greatest ``col`` ever committed to the segments and partitions of the
    newest version, in its sortable text form; None when there is none."""
    m = manifest(spark, path)
    if m is None:
        row = read(spark, path).agg(_mark_text(col).alias("m")).first()
        return row["m"]
    return max((x["marks"][col] for x in m.stats() if x["marks"].get(col) is not None), default=None)


def _mark_text(col: str) -> Column:
    """Times with all six digits and days, so that texts sort as values do."""
    if col in TEXT_MARKS:
        return F.max(col)
    return F.max(F.when(F.typeof(col) == "date", F.col(col).cast("string"))
                 .otherwise(F.date_format(F.col(col).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def mark_value(text: str | None, kind: T.DataType) -> Column:
    """A mark as a literal to compare a column with; NULL selects nothing."""
    return F.lit(text).cast(kind)


# ---- writing --------------------------------------------------------------------


def _write_segment(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] | None) -> dict:
    """A new segment of ``df``: its id, and rows and marks by partition."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    target = f"{path}/{SEG}={name}"
    marks = [c for c in MARKS if c in df.columns]
    measures = [F.count(F.lit(1)).alias("rows"), *[_mark_text(c).alias(c) for c in marks]]
    if partition_by:
        stored = df.schema
        # few folders per task; AQE splits oversized partitions
        df = df.hint("rebalance", *partition_by)
        if sort_by:
            df = df.sortWithinPartitions(*partition_by, *sort_by)
        df.write.partitionBy(*partition_by).parquet(target)
        parts = spark.read.schema(stored).parquet(target).groupBy(_part(partition_by).alias("part")).agg(*measures).collect()
        stats = [{"part": r["part"], "rows": r["rows"], "marks": {c: r[c] for c in marks}} for r in parts]  # one row a partition
    else:
        seen = Observation()
        df.observe(seen, *measures).write.parquet(target)
        got = seen.get or spark.read.schema(df.schema).parquet(target).agg(*measures).first().asDict()
        stats = [{"part": "", "rows": got["rows"], "marks": {c: got[c] for c in marks}}]
    return {"id": name, "stats": stats, "gone": []}


def _evolved(old: Manifest, df: DataFrame) -> dict:
    """The schema with new columns at its end; another type is an error."""
    fields = {f.name: f for f in old.struct().fields}
    for f in df.schema.fields:
        if f.name in fields and fields[f.name].dataType != f.dataType:
            raise TypeError(f"column {f.name} is {fields[f.name].dataType.simpleString()} in the table, {f.dataType.simpleString()} in the batch")
        fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return json.loads(T.StructType(list(fields.values())).json())


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> None:
    """Replace the whole table; ``df`` may read it."""
    spark = df.sparkSession
    segment = _write_segment(df, path, partition_by or [], sort_by)
    old = manifest(spark, path)
    _commit(spark, path, old, Manifest(schema=json.loads(df.schema.json()), partition_by=partition_by or [], segments=[segment],
                                       runs=old.runs if old else []))


def _for_change(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest to add to; a plain folder is taken over first."""
    m = manifest(spark, path)
    if m is None and exists(spark, path):
        overwrite(read(spark, path), path)
        m = manifest(spark, path)
    return m


def append(df: DataFrame, path: str, run: str | None = None) -> None:
    """Add rows.  With ``run`` they are added once: a run that was committed
    before changes nothing."""
    _add(df, path, None, run)


def upsert(df: DataFrame, path: str, key: list[str] | str, run: str | None = None) -> None:
    """Delete every row whose key occurs in ``df``, then insert all of ``df``.
    Written are the rows of ``df`` and the keys that were there before; a NULL
    key replaces nothing."""
    _add(df, path, [key] if isinstance(key, str) else list(key), run)


def _add(df: DataFrame, path: str, key: list[str] | None, run: str | None) -> None:
    spark = df.sparkSession
    old = _for_change(spark, path)
    if old is None:
        overwrite(df, path)
        return _add(df.limit(0), path, None, run) if run else None
    if run is not None and run in old.runs:
        return
    segment = _write_segment(df, path, old.partition_by, None)
    new = Manifest(schema=_evolved(old, df), partition_by=old.partition_by, segments=list(old.segments),
                   deletes=list(old.deletes), runs=[*old.runs, run] if run else old.runs)
    if any(x["rows"] for x in segment["stats"]):
        new.segments.append(segment)
        if key:
            new.deletes += _shadowed(spark, path, old, segment["id"], key)
    elif (new.schema, new.runs) == (old.schema, old.runs):
        return Folder(spark, f"{path}/{SEG}={segment['id']}").delete()
    _commit(spark, path, old, new)
    if len(new.segments) > MAX_SEGMENTS:
        overwrite(read(spark, path), path, new.partition_by)


def _shadowed(spark: SparkSession, path: str, old: Manifest, segment: str, key: list[str]) -> list[dict]:
    """The keys that older segments share with a new one, stored; none if there are none."""
    kind = T.StructType([old.struct()[k] for k in key])
    batch = _raw(spark, path, SEG, [segment], kind).select(*key).distinct()
    shared, name, seen = read(spark, path, kind).join(batch, key, "left_semi").distinct(), uuid.uuid4().hex, Observation()
    target = f"{path}/{DEL}={name}"
    shared.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(target)
    n = (seen.get or {}).get("rows")
    if n is None:
        n = spark.read.schema(kind).parquet(target).count()
    if not n:
        Folder(spark, target).delete()
        return []
    return [{"id": name, "key": key, "segments": [s["id"] for s in old.segments]}]


def replace_partitions(df: DataFrame, path: str, sort_by: list[str] | None = None, gone: list[str] = ()) -> None:
    """Replace the partitions present in ``df``, and those named in ``gone``,
    of a partitioned table; ``df`` may read it."""
    spark = df.sparkSession
    old = manifest(spark, path)
    segment = _write_segment(df, path, old.partition_by, sort_by)
    replaced = {x["part"] for x in segment["stats"]} | set(gone)
    segments = [{**s, "gone": sorted(set(s["gone"]) | replaced & {x["part"] for x in s["stats"]})} for s in old.segments]
    live = [s for s in segments if any(x["part"] not in s["gone"] for x in s["stats"])]
    _commit(spark, path, old, Manifest(schema=_evolved(old, df), partition_by=old.partition_by, segments=[*live, segment],
                                       deletes=old.deletes, runs=old.runs))
    if len(live) >= MAX_SEGMENTS:
        overwrite(read(spark, path), path, old.partition_by, sort_by)


def stored_once(df: DataFrame) -> tuple[DataFrame, str]:
    """df written to a scratch folder, and that folder (for ``drop``)."""
    path = scratch_path(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    Folder(spark, path).delete()

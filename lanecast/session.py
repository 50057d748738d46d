"""Spark session settings and the shared storage folder.

Everything the library writes (layer tables, staged upserts, coverage log,
lineage cuts) goes below the folder the cluster names in
``spark.checkpoint.dir``.  The library reads that setting from the session;
only a local test session without it gets a private folder.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so timestamps equal the oracle's naive
# values, ANSI on (errors instead of silent overflow), AQE for runtime
# coalescing and skew-join splitting.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}

_lock = threading.Lock()


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "lanecast", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs (a cluster brings its own)."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


# Settings that change results: a session that refuses them is an error.
REQUIRED = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")


def apply_conf(spark: SparkSession) -> None:
    """Pin the runtime settings on a session the caller created."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # other static or locked settings stay as the cluster set them
            if k in REQUIRED and spark.conf.get(k, None) != v:
                raise


def size_shuffles(spark: SparkSession, folder: str, tables: tuple[str, ...], part_bytes: int = 2 << 20) -> None:
    """Shuffles start from as many partitions as the given input tables ask for
    (the session's number at least) and are joined only up to 16 MB, and scans are
    split at 32 MB (or below, where the session says so), so that the memory of a
    task does not grow with the input."""
    paths = [Folder(spark, f"{folder.rstrip('/')}/{t}.parquet") for t in tables]
    size = sum(p.fs.getContentSummary(p.hadoop).getLength() for p in paths if p.exists())
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", 16 << 20), ("spark.sql.files.maxPartitionBytes", 32 << 20)):
        if in_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")


def shared_dir(spark: SparkSession) -> str:
    """Root folder for tables and lineage cuts: ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh folder under the system
    temp dir; a cluster session without it is an error, because a
    machine-local folder is not visible to the other executors.
    """
    with _lock:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            cp = spark.sparkContext.getCheckpointDir()
            d = os.path.dirname(cp) if cp else None
        if not d:
            master = spark.sparkContext.master
            if not master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            d = tempfile.mkdtemp(prefix="lanecast-")
            spark.conf.set("spark.checkpoint.dir", d)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
        return d.rstrip("/")


class Folder:
    """A file or folder of the file system a path belongs to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.hadoop = spark, spark._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.hadoop.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.fs.exists(self.hadoop)

    def names(self) -> list[str]:
        """Names in the folder, hidden ones left out; none if it is missing."""
        found = self.fs.listStatus(self.hadoop) if self.exists() else []
        return [n for n in (f.getPath().getName() for f in found) if not n.startswith(".")]

    def files(self) -> list[str]:
        """Files that this glob names, or that lie in a folder it names; hidden ones left out."""
        found = self.fs.globStatus(self.hadoop) or []
        inside = [f for s in found for f in (self.fs.listStatus(s.getPath()) if s.isDirectory() else [s])]
        return sorted(f.getPath().toString() for f in inside if f.isFile() and not f.getPath().getName().startswith(("_", ".")))

    def first_line(self) -> str:
        stream = self.fs.open(self.hadoop)
        try:
            lines = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return lines.readLine() or ""
        finally:
            stream.close()

    def delete(self) -> None:
        if self.exists() and not self.fs.delete(self.hadoop, True):
            raise OSError(f"cannot delete {self.hadoop}")

    def rename(self, to: Folder) -> None:
        if not self.fs.rename(self.hadoop, to.hadoop):
            raise OSError(f"cannot rename {self.hadoop} to {to.hadoop}")

    def read_text(self) -> str:
        stream = self.fs.open(self.hadoop)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, text: str) -> None:
        stream = self.fs.create(self.hadoop, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


_scopes = threading.local()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new unique folder under the shared dir (for staged writes)."""
    path = "/".join([shared_dir(spark), "lanecast", *parts, uuid.uuid4().hex])
    for made in getattr(_scopes, "open", [])[-1:]:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch folders named inside are removed at the end."""
    _scopes.open = [*getattr(_scopes, "open", []), []]
    try:
        yield
    finally:
        for path in _scopes.open.pop():
            Folder(spark, path).delete()

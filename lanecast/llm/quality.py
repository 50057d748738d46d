"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules look at one document.  The method looks across documents: lines
are normalised (trimmed, lower case, numbers as 0) and hashed; for each host
(the source of a document) and line the distinct documents that hold it are
counted.  A line above the limit, the same for hosts of every size, is
boilerplate and is removed from all documents but the one with the smallest id;
a document that is left with too few of its words is depleted and rejected.

Counts are pre-aggregated before every shuffle; one hot host or line is only a
counter per task, and lines go back to their documents by a join that Spark
may split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecast.llm.common import SPACE_CLASS, WORD_CLASS, stored, text_of


@dataclass(frozen=True)
class Rules:
    """Base: least words, window of words, most repeated words in percent.
    Method: a line is boilerplate in a host if more than line_docs documents of
    the host hold it; a document is depleted if less than left_percent of its
    words are left."""

    least_words: int = 10
    window: int = 5
    repeat_percent: int = 20
    line_docs: int = 20
    left_percent: float = 20.0


def words_of(text: Column) -> Column:
    """Words of a text as an array."""
    return F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != "")


def line_hash(line: Column) -> Column:
    """Hash of a normalised line."""
    return F.xxhash64(F.regexp_replace(F.lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))), "[0-9]+", "0"))


def repeated_words(hashes: str, size: int) -> Column:
    """Words covered by windows whose hash occurs twice or more in the array.

    Only where a hash repeats: windows are sorted by hash and position, those
    with an equal neighbour are kept, and each counts up to the next one's start."""
    h = F.col(hashes)
    kind = "array<struct<h:bigint,i:int>>"
    none = F.array(F.struct(F.lit(None).cast("bigint").alias("h"), F.lit(-1).alias("i")))
    at = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))).cast(kind)
    rows = F.arrays_zip(at.alias("x"), F.concat(none, F.slice(at, 1, F.size(h) - 1)).alias("prev"),
                        F.concat(F.slice(at, 2, F.size(h)), none).alias("next"))
    twice = F.filter(rows, lambda r: F.coalesce(r["x"]["h"] == r["prev"]["h"], F.lit(False))
                     | F.coalesce(r["x"]["h"] == r["next"]["h"], F.lit(False)))
    covered = F.aggregate(F.sort_array(F.transform(twice, lambda r: r["x"]["i"])),
                          F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last")),
                          lambda a, i: F.struct((a["n"] + F.least(F.lit(size), i - a["last"])).alias("n"), i.alias("last")),
                          lambda a: a["n"])
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered).cast("long")


def measured(docs: DataFrame, rules: Rules, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per id and text: host, text_hash, the base counts, and for each
    line with a word its hash (lines.h) and words (lines.w)."""
    size = rules.window
    d = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), text_of(text_col).alias("text"))
    d = d.select("id", "host", "text", words_of(F.col("text")).alias("words"),
                 F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_CLASS)).alias("own_lines"))
    d = d.select("id", "host", F.xxhash64("text").alias("text_hash"),
                 F.size("words").cast("long").alias("n_words"),
                 F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                 F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                 (F.size("own_lines") - F.size(F.array_distinct("own_lines"))).cast("long").alias("n_dup_lines"),
                 F.transform("own_lines", lambda x: F.struct(
                     line_hash(x).alias("h"), F.regexp_count(x, F.lit(f"{WORD_CLASS}+")).alias("w"))).alias("lines"),
                 F.when(F.size("words") >= size, F.transform(F.sequence(F.lit(1), F.size("words") - (size - 1)),
                                                             lambda i: F.xxhash64(F.slice("words", i, size))))
                 .otherwise(F.array().cast("array<bigint>")).alias("window_hashes"))
    return d.select("*", repeated_words("window_hashes", size).alias("n_repeat_words")).drop("window_hashes")


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def boilerplate(rows: DataFrame, rules: Rules) -> DataFrame:
    """host, h, first (the smallest id that holds the line): lines above the limit.

    The documents of a host that hold a line are counted once each, by id (a null
    id is not counted); every shuffle is pre-aggregated."""
    held = rows.select("host", "id", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    return (held.distinct().groupBy("host", "h").agg(F.count("id").alias("docs"), F.min("id").alias("first"))
            .filter(F.col("docs") > rules.line_docs).select("host", "h", "first"))


def verdicts(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source") -> DataFrame:
    """The id, text_hash, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, removed_words, kept: one row per id and text.

    Rows that repeat an id and a text (whatever their host, the smallest
    counts) are one.  A null text is empty and fails the base rules; a null
    host is a host, a null id an id that is never the smallest.  An empty table
    gives no rows; other columns are not looked at.
    """
    rows = stored(measured(docs, rules, id_col, text_col, host_col), "quality")
    return _verdicts(rows, removed_lines(rows, rules), rules, id_col)


def removed_lines(rows: DataFrame, rules: Rules) -> DataFrame:
    """host, id, text_hash, h, w: the boilerplate lines of all documents but the first."""
    lines = rows.select("host", "id", "text_hash", F.explode("lines").alias("line")).select(
        "host", "id", "text_hash", F.col("line.h").alias("h"), F.col("line.w").alias("w"))
    often = boilerplate(rows, rules).withColumnsRenamed({"host": "_host", "h": "_h"})
    return (lines.join(often, F.col("host").eqNullSafe(F.col("_host")) & (F.col("h") == F.col("_h")))
            .filter(~F.col("id").eqNullSafe(F.col("first"))).select("host", "id", "text_hash", "h", "w"))


def _verdicts(rows: DataFrame, gone: DataFrame, rules: Rules, id_col: str) -> DataFrame:
    removed = gone.groupBy(F.col("id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.sum("w").alias("words"))
    base = rows.groupBy("id", "text_hash").agg(*[F.max(c).alias(c) for c in COUNTS], F.count(F.lit(1)).alias("copies"))
    n, repeat = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < rules.least_words) | (100 * repeat > rules.repeat_percent * n)
    out = (base.join(removed, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
           .withColumn("removed_words", F.coalesce((F.col("words") / F.col("copies")).cast("long"), F.lit(0).cast("long")))
           .withColumn("base_failed", failed))
    depleted = (F.col("removed_words") > 0) & (
        (n - F.col("removed_words")) * 100.0 < n * F.lit(rules.left_percent))
    return out.select(F.col("id").alias(id_col), "text_hash", *COUNTS, "base_failed", "removed_words",
                      (~F.col("base_failed") & ~depleted).alias("kept"))


def accepted(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source") -> DataFrame:
    """The rows of docs that are kept, with all their columns, their texts without
    the boilerplate lines of their host (but in the first document that holds one).

    A null text fails the base rules and goes; a null host is a host; a null id is no
    document in the counts and never the first; rows that repeat an id and a text
    share its verdict and stay as often as they are there; an empty table gives no rows.
    Columns named __quality_* are not allowed.
    """
    rows = stored(measured(docs, rules, id_col, text_col, host_col), "quality")
    gone = removed_lines(rows, rules)
    rejected = _verdicts(rows, gone, rules, "_id").filter("not kept").select(
        F.col("_id").alias("__quality_id"), F.col("text_hash").alias("__quality_hash"))
    # at most as many hashes as the text has lines
    cut = gone.groupBy(F.col("id").alias("__quality_id"), F.col("text_hash").alias("__quality_hash"),
                       F.col("host").alias("__quality_host")).agg(F.collect_set("h").alias("__quality_gone"))
    same = F.col(id_col).eqNullSafe(F.col("__quality_id")) & (F.xxhash64(text_of(text_col)) == F.col("__quality_hash"))
    lines = F.filter(F.split(text_col, "\n"),
                     lambda x: ~(x.rlike(WORD_CLASS) & F.array_contains("__quality_gone", line_hash(x))))
    text = F.when(F.col("__quality_gone").isNull(), F.col(text_col)).otherwise(F.array_join(lines, "\n"))
    return (docs.join(rejected, same, "left_anti")
            .join(cut, same & F.col(host_col).eqNullSafe(F.col("__quality_host")), "left")
            .withColumn(text_col, text).select(*docs.columns))

"""Mixing sources to target weights on a time-varying curriculum.

Every source i has a target of training words T_i and a weight schedule over
training time t in [0, 1]: w_i(t) = T_i * (1 + a_i * (2t - 1)), which rises
(a > 0) or falls (a < 0) over the run.  Its integral is the cumulative demand
D_i(t) = T_i * ((1 - a_i) * t + a_i * t^2), with D_i(1) = T_i.  The documents
of a source, in a fixed pseudo-random order and pass by pass, lie end to end
on the source's word line; a document whose middle lies at word c is trained
on at the time t where D_i(t) = c.  Its training position is the demand of all
sources together up to t, in words: A t + B t^2 with A = sum of T_i (1 - a_i)
and B = sum of T_i a_i.  The mix is range-sorted by position.

Targets: the sources, ordered by code point with null last, weigh 5, 2, 1,
5, 2, 1, ... and share 150 % of all words; no target exceeds twice its
source's words, and what is cut off is shared again by weight until none does.
Documents are taken whole: all of them floor(T_i / words) times, then a prefix
of the order that fits what is left, then the one document that fits the
gap best, and so on with a prefix of the documents that fit the new gap, until
the gap is less than the smallest document not taken.  Two rounds halve a gap.

The running totals over a source are built from totals of small hash buckets
of its documents, so a source that holds most rows is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanecast.llm.common import n_words, stored, text_of


# Keys over which a source's rows are spread in a join.
SALTS = 32


@dataclass(frozen=True)
class Mix:
    """weights: repeated over the sources in order; slopes: a_i, likewise;
    share: target words over all words; most: target over the source's words;
    bucket_rows: documents of a hash bucket, about."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    slopes: tuple[float, ...] = (-0.5, 0.0, 0.5)
    share: float = 1.5
    most: float = 2.0
    bucket_rows: int = 500


def _cycle(values: tuple[float, ...], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (at % len(values) + 1).cast("int"))


def targets(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """src, source_size, n_docs, target, slope and, over all sources, the
    coefficients of the cumulative demand (rise, bend): one row per source.

    The level L at which sum(min(most * size, L * weight)) is the total share
    is found by ordering the sources by the level at which each one is full.
    """
    order = Window.orderBy(F.col("src").asc_nulls_last())
    by_full = Window.orderBy("full", F.col("src").asc_nulls_last())
    before = by_full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = (sized.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
         .withColumn("rank", F.row_number().over(order) - 1)
         .select("src", "source_size", "n_docs", _cycle(mix.weights, F.col("rank")).alias("weight"),
                 _cycle(mix.slopes, F.col("rank")).alias("slope"),
                 (F.col("source_size") * F.lit(float(mix.most))).alias("cap"))
         .withColumn("full", F.col("cap") / F.col("weight"))
         .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(mix.share)))
         .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("weight_left", F.sum("weight").over(by_full.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("own", F.col("left") / F.col("weight_left"))
         .withColumn("level", F.min(F.when(F.col("own") <= F.col("full"), F.struct("full", "src", "own"))).over(everything)["own"]))
    s = s.select("src", "source_size", "n_docs", "slope",
                 F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))
    return s.select("*", F.sum(F.col("target") * (1.0 - F.col("slope"))).over(everything).alias("rise"),
                    F.sum(F.col("target") * F.col("slope")).over(everything).alias("bend"))


def plan(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """One row per document: the id, text_hash, size, src, source_size, target,
    taken (words), times and positions (arrays: the training time, and the words
    that the mix demands before it, of each time the document is taken).

    A null text has no words; documents without words are taken zero words but
    keep their place in the passes.  A null id is an id like any other, a null source is
    the last source.  Rows that repeat an id and a text are one document.  Ties
    in the order are broken by id and text.  An empty table gives no rows; other
    columns are not looked at.
    """
    text = text_of(text_col)
    sized = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("src"),
                               F.xxhash64(text).alias("text_hash"), n_words(text).alias("size"))
                   .groupBy("id", "text_hash").agg(F.max("size").alias("size"), F.min("src").alias("src")), "mix")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rows = (_by_source(sized, stored(targets(sized, mix), "mix")).withColumn("h", F.xxhash64("id", "text_hash", F.lit("mix")))
            .withColumn("passes", passes).withColumn("gap", F.col("target") - F.col("passes") * F.col("source_size"))
            .withColumn("base", F.lit(0).cast("long")))
    placed = stored(_placed(rows, mix), "mix")
    laid, later = _laid(placed), []
    left = _still_fit(laid)
    while not left.isEmpty():
        more = stored(_laid(_placed(left, mix)), "mix")
        later.append(more.filter("begin is not null").select(
            F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("begin").alias("_begin")))
        left = _still_fit(more)
    if later:
        picked = reduce(DataFrame.unionByName, later)
        laid = (laid.join(picked, (F.col("text_hash") == F.col("_hash")) & F.col("id").eqNullSafe(F.col("_id")), "left")
                .withColumn("begin", F.coalesce("begin", "_begin")).drop("_id", "_hash", "_begin"))
    middle = F.col("size") / 2.0
    once_more = F.when(F.col("begin").isNotNull(), F.array(F.col("begin") + middle)).otherwise(F.array().cast("array<double>"))
    words_at = F.concat(
        F.when(F.col("passes") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1),
                                                lambda p: p * F.col("source_size") + F.col("start") + middle))
        .otherwise(F.array().cast("array<double>")),
        F.transform(once_more, lambda c: F.col("passes") * F.col("source_size") + c))
    times = F.transform(words_at, lambda c: training_time(c / F.col("target"), F.col("slope")))
    positions = F.transform("times", lambda t: t * (F.col("rise") + F.col("bend") * t))
    return (laid.withColumn("times", times)
            .select(F.col("id").alias(id_col), "text_hash", "src", "size", "source_size", "target",
                    (F.col("size") * F.size("times")).cast("long").alias("taken"), "times", positions.alias("positions")))


def _placed(rows: DataFrame, mix: Mix) -> DataFrame:
    """rows (src, n_docs, h, id, text_hash, size) with start: the words of the
    source's rows before each one, in earlier buckets and in its own bucket."""
    # place in the source's order: the hash h; u is h as a share of the hash range
    u = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    bucket = F.floor(u * F.ceil(F.col("n_docs") / F.lit(float(mix.bucket_rows)))).cast("long")
    d = rows.select("*", u.alias("u"), bucket.alias("bucket"))
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("src", "bucket").orderBy("u", "id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (d.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
               .select(F.col("src").alias("b_src"), F.col("bucket").alias("b_bucket"),
                       F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")))
    start = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return (d.join(buckets, F.col("src").eqNullSafe(F.col("b_src")) & (F.col("bucket") == F.col("b_bucket")))
            .withColumn("start", start).drop("b_src", "b_bucket", "offset", "bucket", "u", "n_docs"))


def _laid(placed: DataFrame) -> DataFrame:
    """placed with filled (words of the gap that this round takes) and begin
    (the word of the remainder at which a document lies, null if not taken):
    the prefix that fits the gap, then the one document that fits the rest best."""
    end = F.col("start") + F.col("size")
    fits = (F.col("size") > 0) & (end <= F.col("gap"))
    laid = _by_source(placed, placed.groupBy("src").agg(F.coalesce(F.max(F.when(fits, end)), F.lit(0)).alias("prefix")))
    best = ~fits & (F.col("size") > 0) & (F.col("size") <= F.col("gap") - F.col("prefix"))
    key = F.struct("size", "h", "text_hash", "id")
    laid = _by_source(laid, laid.groupBy("src").agg(F.max(F.when(best, key)).alias("last")))
    is_last = F.coalesce(key.eqNullSafe(F.col("last")) & best, F.lit(False))
    begin = F.when(fits, F.col("base") + F.col("start")).when(is_last, F.col("base") + F.col("prefix"))
    return (laid.withColumn("begin", begin)
            .withColumn("filled", F.col("prefix") + F.coalesce(F.col("last.size"), F.lit(0))).drop("prefix", "last"))


def _still_fit(laid: DataFrame) -> DataFrame:
    """Documents that were not taken and fit what is left of their source's gap."""
    left = (laid.withColumn("base", F.col("base") + F.col("filled")).withColumn("gap", F.col("gap") - F.col("filled"))
            .filter(F.col("begin").isNull() & (F.col("size") > 0) & (F.col("size") <= F.col("gap")))
            .select("id", "text_hash", "src", "size", "h", "base", "gap"))
    return _by_source(left, left.groupBy("src").agg(F.count(F.lit(1)).alias("n_docs")))


def _by_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Join one row per source.  A source's rows go to SALTS keys by their hash and
    its row to each of them, so a shuffled join spreads a source that holds most rows."""
    keyed = sources.withColumnRenamed("src", "_src").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("id", "text_hash"), F.lit(SALTS)).cast("int")
    return (rows.withColumn("salt", salt)
            .join(keyed, F.col("src").eqNullSafe(F.col("_src")) & (F.col("salt") == F.col("_salt"))).drop("_src", "_salt", "salt"))


def training_time(y: Column, slope: Column) -> Column:
    """t with (1 - a) * t + a * t^2 = y: the demand curve inverted, for 0 <= y <= 1."""
    b = 1.0 - slope
    return F.least(F.lit(1.0), 2.0 * y / (b + F.sqrt(F.greatest(F.lit(0.0), b * b + 4.0 * slope * y))))


def mix(docs: DataFrame, how: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The columns of docs, one row for each time a document is trained on,
    range-sorted by position, ties by id and text.  Cases as in `plan`; of rows that
    repeat an id and a text the one with the smallest source, then the smallest other
    columns (as JSON) stays.  Columns named __mix_* are not allowed.

    Written to files the rows keep this order, and `in_order` gives it back."""
    p = plan(docs, how, id_col, text_col, source_col).filter(F.size("times") > 0).select(
        F.col(id_col).alias("__mix_id"), F.col("text_hash").alias("__mix_hash"), F.col("positions").alias("__mix_positions"))
    others = [c for c in docs.columns if c not in (id_col, text_col, source_col)]
    rank = F.struct(F.col(source_col).isNull(), F.col(source_col), F.to_json(F.struct(*others)) if others else F.lit(""))
    d = (docs.withColumn("__mix_text", F.xxhash64(text_of(text_col))).groupBy(F.col(id_col).alias("__mix_doc"), "__mix_text")
         .agg(F.min_by(F.struct(*docs.columns), rank).alias("__mix_row")))
    order = ("__mix_position", id_col, "__mix_hash")
    return (d.join(p, F.col("__mix_doc").eqNullSafe(F.col("__mix_id")) & (F.col("__mix_text") == F.col("__mix_hash")))
            .select("__mix_row.*", "__mix_hash", F.explode("__mix_positions").alias("__mix_position"))
            .repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order).select(*docs.columns))


def in_order(written: DataFrame) -> DataFrame:
    """The rows of a mix read from its files, with position: their place (from 0)
    in training order, whatever order the files are read in.

    Files of a sorted write are numbered in order, so a row's place is its number in
    the file plus the rows of earlier files; only one row per file is put in order
    and sent to the rows, which are not shuffled.
    A frame that is not read from files is written first, in its own order.  Nulls and
    repeated rows have places like any other; an empty table gives no rows; a column
    named position is replaced.
    """
    if not written.inputFiles():
        written = stored(written, "mix")
    part = F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1)
    rows = written.drop("position").select("*", F.struct(F.when(part != "", part.cast("long")).alias("part"),
                                                         F.col("_metadata.file_path").alias("path")).alias("__mix_file"),
                                           F.col("_metadata.row_index").alias("__mix_row"))
    before = Window.orderBy("__mix_file").rowsBetween(Window.unboundedPreceding, -1)
    files = (rows.groupBy("__mix_file").agg(F.count(F.lit(1)).alias("n"))
             .select(F.col("__mix_file").alias("__mix_of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__mix_before")))
    return (rows.join(F.broadcast(files), F.col("__mix_file").eqNullSafe(F.col("__mix_of")))
            .select(*[c for c in written.columns if c != "position"], (F.col("__mix_before") + F.col("__mix_row")).alias("position")))

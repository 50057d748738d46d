"""The corpus pipeline: documents through the stages of training-data preparation.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written to the shared folder as Parquet and read again as the next one's docs.
All stages but the last return the columns of documents.  An empty table goes
through all stages; null texts, null ids, repeated rows and extra columns are
handled as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecast.llm import bpe, mixing, quality, secrets, simhash
from lanecast.llm.catalog import WORD_BPE
from lanecast.llm.common import prepare, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not depleted of their own lines,
    their texts without boilerplate lines; n_chars follows the text.  Null and empty
    texts fail the base rules; other cases as in `quality.accepted`."""
    prepare(spark)
    kept = quality.accepted(docs)
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; cases as in
    `simhash.deduplicate` (null and empty texts link like any other)."""
    prepare(spark)
    return simhash.deduplicate(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their text replaced; n_chars follows the text."""
    prepare(spark)
    clean = secrets.redact(docs, secrets.train(docs))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    prepare(spark)
    return mixing.mix(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, position (from 0, the training order in which the mix was written),
    n_tokens, ids and decoded_sha256 (of the text that the ids decode to) of every row.

    One row per row: null texts have no tokens, null ids and repeated rows stay."""
    prepare(spark)
    path = public_tokenizers.path(WORD_BPE)
    decoded = bpe.decode(bpe.encode(mixing.in_order(docs), path, keep=("position",)), path)
    return decoded.withColumn("decoded_sha256", F.sha2("text", 256)).drop("text")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan),
          ("source_mix", source_mix), ("bpe_encoding", bpe_encoding)]

ORACLE_SQL = None  # fingerprints, a trained network and token ids are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline", name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Queries of this subpackage: opN_<name>(spark, sf_dir), and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecast.llm import bpe, fim, gam, hmm, merkle, mixing, pii, quality, secrets, simhash, suffix, vafile, warc
from lanecast.llm.common import prepare, table
from lanecast.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The tokenizer file of op10; a parameter of the operator.
WORD_BPE = "word_bpe_49k.json"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir.rstrip("/"))
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm", "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.resolve(warc.read_records(spark, path))


@query
def op2_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scores(table(spark, sf_dir, "documents"))


@query
def op3_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return d.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


@query
def op4_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


@query
def op5_vafile_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"))


ORACLE["op5_vafile_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
), scored AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * x.c[i])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query
def op6_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removals(table(spark, sf_dir, "documents")).drop("spans")


@query
def op7_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents")).drop("text_hash", "removed_words")


ORACLE["op7_quality_lines"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), wins AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS lw,
         regexp_replace(lower(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[0-9]+', '0', 'g') AS k
  FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY doc_id
), held AS (
  SELECT source, k, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_id FROM lines GROUP BY source, k
), often AS (
  SELECT * FROM held WHERE docs > 20
), removed AS (
  SELECT doc_id, sum(lw) AS n FROM lines JOIN often
    ON lines.source IS NOT DISTINCT FROM often.source AND lines.k = often.k AND lines.doc_id <> often.first_id
  GROUP BY doc_id
), base AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(removed.n, 0) AS gone
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN removed USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         gone > 0 AND (n_words - gone) * 100.0 < n_words * 20.0 AS depleted FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT depleted AS kept FROM judged"""


@query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = mixing.plan(table(spark, sf_dir, "documents"))
    return p.select("doc_id", "size", "source_size", "target", "taken", F.array_min("times").alias("first_time"),
                    F.array_min("positions").alias("first_position"))


@query
def op9_secret_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs))


@query
def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


@query
def op11_fim_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


ORACLE["op11_fim_captures"] = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), h AS (
  SELECT *, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
         CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d
), k AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), s AS (
  SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1, n - b) AS suffix FROM k
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM s"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.checked(table(spark, sf_dir, "documents"))


ORACLE["op12_merkle_manifest"] = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars, CAST(doc_id AS VARCHAR) AS k,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents
), keyed AS (
  SELECT *, list_reduce(list_prepend(4294967295, range(8 * len(k))), lambda crc, i: xor(
      (CASE WHEN i % 8 = 0 THEN xor(crc, CAST(ascii(substr(k, i // 8 + 1, 1)) AS BIGINT)) ELSE crc END) >> 1,
      ((CASE WHEN i % 8 = 0 THEN xor(crc, CAST(ascii(substr(k, i // 8 + 1, 1)) AS BIGINT)) ELSE crc END) & 1) * 3988292384)) AS crc
  FROM fields
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 7 = 0 AND n_chars IS NOT NULL
              THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || tail) END AS tampered
  FROM keyed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS gid FROM leaves
), up AS (
  SELECT 0 AS level, gid, idx, n, leaf AS h FROM placed
  UNION ALL
  SELECT max(level) + 1, gid, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY gid, idx // 2
), tops AS (
  SELECT gid, level AS height, h AS subroot FROM up WHERE n = 1
), over_ AS (
  SELECT 0 AS level, gid AS idx, (SELECT count(*) FROM tops) AS n, subroot AS h FROM tops
  UNION ALL
  SELECT max(level) + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM over_ WHERE n > 1 GROUP BY idx // 2
), top AS (
  SELECT level AS height, h AS root FROM over_ WHERE n = 1
), steps AS (
  SELECT t.gid, p.idx AS leaf_at, l.level AS step, (p.idx >> l.level) % 2 = 1 AS mine_last, s.h
  FROM placed p JOIN tops t ON p.gid = t.gid JOIN (SELECT DISTINCT gid, level FROM up WHERE n > 1) l ON l.gid = p.gid
  LEFT JOIN up s ON s.gid = p.gid AND s.level = l.level AND s.idx = xor(p.idx >> l.level, 1)
  UNION ALL
  SELECT t.gid, p.idx, t.height + l.level, (t.gid >> l.level) % 2 = 1, s.h
  FROM placed p JOIN tops t ON p.gid = t.gid CROSS JOIN (SELECT DISTINCT level FROM over_ WHERE n > 1) l
  LEFT JOIN over_ s ON s.level = l.level AND s.idx = xor(t.gid >> l.level, 1)
), proofs AS (
  SELECT gid, leaf_at, string_agg(coalesce(h, ''), '' ORDER BY step) AS proof,
         list(CASE WHEN h IS NULL THEN '=' WHEN mine_last THEN '<' || h ELSE '>' || h END ORDER BY step) AS path FROM steps GROUP BY gid, leaf_at
), folded AS (
  SELECT p.*, t.subroot, coalesce(f.proof, '') AS proof, list_reduce(list_prepend(coalesce(p.tampered, p.leaf), coalesce(f.path, [])),
      lambda h, s: sha256(CASE s[1] WHEN '<' THEN s[2:] || h WHEN '>' THEN h || s[2:] ELSE h END)) AS folded_root
  FROM placed p JOIN tops t ON p.gid = t.gid LEFT JOIN proofs f ON f.gid = p.gid AND f.leaf_at = p.idx
)
SELECT doc_id, leaf, subroot, (SELECT root FROM top) AS root, sha256(proof) AS proof_sha256, folded_root,
       folded_root = (SELECT root FROM top) AS verified FROM folded"""


@query
def op13_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

"""Hidden Markov language model over whole documents.

Words and one end form a document's tokens.  The corpus counts of all training
tokens give a base model: (c + 1) / (N + V + 1) for a token seen c times, one
unseen type included.  The hidden Markov model gives every word of the training
text an emission of its own in every latent state s, from the expected count
E(w, s) of Baum-Welch and the state's share q(s) of all tokens:

    P(w | s) = (1 - u) (E(w, s) + prior q(s)) / (sum of E(., s) + prior q(s) V)

A word that s has not emitted is as likely there as a rare word of the corpus,
so rare words are smoothed and frequent ones are not; an unseen word has the
base model's u = 1 / (N + V + 1) in every state.  The table of E grows with the
vocabulary and is never in one place: it is stored by word and joined to the
words of each chunk, as the counts c are.  It travels packed: words are dealt into
buckets of a bounded number of uses, a chunk asks each bucket for its words in one
row and gets one back; expected counts keep 16 bits of precision in the table (the
model is what the table says, its likelihoods are exact).

Steps: (1) tasks cut their documents into chunks of a bounded number of tokens,
each with its own word list; (2) the words of all chunks are counted, numbered
and sent back to their chunks; (3) Baum-Welch: each chunk meets the emissions of
its words, runs the scaled forward and backward recursions and gives expected
counts, which are summed by word across partitions; (4) the scaled forward
recursion gives the exact log likelihood of every document.
"""

from __future__ import annotations

import gc
import hashlib
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.llm.common import LOWER_AZ, arrow_schema, as_array, map_batches, stored, text_of
from lanecast.session import Folder

END = "\n"  # the end; white space is never a word

CHUNKS = ("chunk bigint, ids array<bigint>, held array<boolean>, lengths array<int>, tokens binary, "
          "words array<string>, counts array<bigint>")
CORPUS = ("chunk bigint, ids array<bigint>, held array<boolean>, lengths array<int>, tokens binary, "
          "known array<bigint>, base array<double>, wids array<bigint>, counts array<bigint>")


@dataclass(frozen=True)
class Model:
    """Latent states, Baum-Welch rounds over all training text, pseudo
    occurrences of a word in the estimates, tokens of a chunk (about), uses of
    words (a word counts once per chunk) of a bucket (about).
    The first estimate comes from `start_docs` windows of at most `start_tokens`
    tokens of training documents of any length (the smallest hashes)."""

    states: int = 6
    rounds: int = 2
    prior: float = 1.0
    chunk_tokens: int = 4_000_000
    bucket_uses: int = 1 << 18
    start_docs: int = 256
    start_tokens: int = 1000
    start_rounds: int = 12
    held_modulus: int = 7
    held_remainder: int = 2


def chunks(docs: DataFrame, model: Model, id_col: str, text_col: str) -> DataFrame:
    """Documents as chunks of token numbers with the chunk's words and their training counts."""
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % model.held_modulus == model.held_remainder
    rows = docs.select(F.col(id_col).cast("bigint"), held, text_of(text_col))
    schema = arrow_schema(CHUNKS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0

        def full() -> pa.RecordBatch:
            tokens = np.concatenate(seqs)
            train = np.repeat(~np.array(is_held), [len(s) for s in seqs])
            counts = np.bincount(tokens[train], minlength=len(index))
            packed = pack(tokens.astype("<i4"))
            words = [w if isinstance(w, str) else w.decode() for w in index]
            row = [[part << 32 | made], [ids], [is_held], [[len(s) for s in seqs]], [packed], [words], [counts]]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema)

        ids, is_held, seqs, size, index = [], [], [], 0, {}
        for b in batches:
            for i, h, t in zip(*(c.to_pylist() for c in b.columns)):
                words = t.encode().translate(LOWER_AZ).split()
                words.append(END)
                for w in words:
                    if w not in index:
                        index[w] = len(index)
                seqs.append(np.fromiter(map(index.__getitem__, words), dtype=np.int32, count=len(words)))
                ids.append(i)
                is_held.append(h)
                size += len(words)
                if size >= model.chunk_tokens:
                    yield full()
                    made += 1
                    ids, is_held, seqs, size, index = [], [], [], 0, {}
        if ids:
            yield full()

    return rows.mapInArrow(run, CHUNKS)


@dataclass
class Base:
    """Base model: training tokens and distinct ones."""

    tokens: int
    types: int

    @property
    def total(self) -> float:
        return float(self.tokens + self.types + 1)


def counted(cut: DataFrame) -> tuple[DataFrame, Base]:
    """chunk, idx, wid (a number of the word), c of every word of every chunk;
    the base model.  Counts are pre-aggregated; a word is one row per chunk in
    the join that brings them back, which Spark may split."""
    words = cut.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("idx", "x")).select(
        "chunk", "idx", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    vocabulary = stored(words.groupBy("word").agg(F.sum("n").alias("c")).withColumn("wid", F.monotonically_increasing_id()), "hmm", "words")
    base = vocabulary.filter("c > 0").agg(F.sum("c").alias("n"), F.count("c").alias("v")).first()
    uses = stored(words.drop("n").join(vocabulary, "word").select("chunk", "idx", "wid", "c"), "hmm", "uses")
    release(vocabulary)
    return uses, Base(base["n"] or 0, base["v"])


def numbered(cut: DataFrame, uses: DataFrame, base: Base) -> DataFrame:
    """Chunks with the number and count of each of their words and, by
    document, the tokens known and the base score."""
    total, schema = base.total, arrow_schema(CORPUS)

    def run(c: pa.Table, w: pa.Table) -> pa.Table:
        out = {f.name: [] for f in schema}
        idx = w["idx"].to_numpy()
        count, wid = np.zeros(len(idx), np.int64), np.zeros(len(idx), np.int64)
        count[idx], wid[idx] = w["c"].to_numpy(), w["wid"].to_numpy()
        log_base = np.log10(count + 1.0) - np.log10(total)
        for row in c.to_pylist():
            tokens, at = unpacked(row["tokens"]), begins(row["lengths"])
            out["known"].append(np.add.reduceat((count > 0).astype(np.int64)[tokens], at))
            out["base"].append(np.add.reduceat(log_base[tokens], at))
            out["wids"].append(wid)
            out["counts"].append(count)
            for f in ("chunk", "ids", "held", "lengths", "tokens"):
                out[f].append(row[f])
        return pa.table([as_array(out[f.name], f.type) for f in schema], schema=schema)

    return (cut.select("chunk", "ids", "held", "lengths", "tokens").groupBy("chunk")
            .cogroup(uses.groupBy("chunk")).applyInArrow(run, CORPUS))


def pack(a: np.ndarray) -> bytes:
    """Fixed-width rows, compressed byte by byte position (high bytes are mostly alike)."""
    rows = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(rows.T).tobytes())


def unpack(b: bytes, kind: str, columns: int = 1) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    a = np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize * columns, -1).T).view(kind)
    return a.reshape(-1, columns) if columns > 1 else a.reshape(-1)


def unpacked(tokens: bytes) -> np.ndarray:
    return unpack(tokens, "<i4")


def pack_words(wids: np.ndarray) -> bytes:
    """Ascending word numbers, as differences."""
    return pack(np.diff(wids, prepend=0).astype("<i8"))


def unpack_words(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, "<i8"))


def pack_counts(expected: np.ndarray) -> bytes:
    """Expected counts as floats of 16 bits of precision, rounded to nearest."""
    bits = np.ascontiguousarray(expected, dtype="<f4").view("<u4")
    return pack((bits + np.uint32(0x80)) & np.uint32(0xFFFFFF00))


def dealt(wids: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts words by bucket and number, the buckets present and
    where each one begins (and the last ends)."""
    bucket = ((wids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((wids, bucket))
    present, at = np.unique(bucket[order], return_index=True)
    return order, present, np.append(at, len(wids))


def begins(lengths) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(int)


@dataclass
class Params:
    """What all words share: start and transition probabilities, the expected
    tokens of each state, the base model and the prior."""

    start: np.ndarray
    move: np.ndarray
    totals: np.ndarray
    base: Base
    prior: float

    @classmethod
    def estimate(cls, start: np.ndarray, move: np.ndarray, totals: np.ndarray, base: Base, prior: float) -> Params:
        return cls((start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(axis=1, keepdims=True), totals, base, prior)

    def emissions(self, expected: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """P(w | s) of words (rows) with their expected counts by state."""
        unseen = 1 / self.base.total
        weight = self.prior * (self.totals + 1) / (self.totals + 1).sum()
        seen = (1 - unseen) * (expected + weight) / np.maximum(self.totals + weight * self.base.types, 1e-300)
        return np.where(counts[:, None] > 0, seen, unseen)


class HMM:
    """Start, transition and emission probabilities, the latter by word (rows)."""

    def __init__(self, params: Params, emit: np.ndarray):
        self.start, self.move, self.emit = params.start, params.move, np.ascontiguousarray(emit)

    def layout(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest sequence first; sequences alive at each step; where steps begin."""
        order = np.argsort(-lengths, kind="stable")
        steps = int(lengths.max()) if len(lengths) else 0
        alive = np.searchsorted(-lengths[order], -np.arange(steps), "left")
        return order, alive, np.concatenate(([0], np.cumsum(alive)))

    def log_likelihood(self, seq: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 likelihood of the tokens of each sequence (laid end to end)."""
        order, alive, _ = self.layout(lengths)
        begin, total = (np.cumsum(lengths) - lengths)[order], np.zeros(len(lengths))
        a = np.broadcast_to(self.start, (len(lengths), len(self.start)))
        for t, n in enumerate(alive):
            a = (a[:n] if t == 0 else a[:n] @ self.move) * self.emit[seq[begin[:n] + t]]
            scale = a.sum(axis=1)
            a /= scale[:, None]
            total[:n] += np.log10(scale)
        out = np.empty(len(lengths))
        out[order] = total
        return out

    def expected(self, seq: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions (words x states) by the forward and backward recursions."""
        g, k = self.emit.shape
        order, alive, at = self.layout(lengths)
        begin = (np.cumsum(lengths) - lengths)[order]
        emit, move = self.emit.astype(np.float32), self.move.astype(np.float32)
        alpha = np.empty((at[-1], k), dtype=np.float32)   # by step, then by sequence
        sym = np.empty(at[-1], dtype=np.int32)
        scale = np.empty(at[-1], dtype=np.float32)
        a = np.broadcast_to(self.start.astype(np.float32), (len(lengths), k))
        for t, n in enumerate(alive):
            lo, hi = at[t], at[t + 1]
            sym[lo:hi] = seq[begin[:n] + t]
            a = (a[:n] if t == 0 else a[:n] @ move) * emit[sym[lo:hi]]
            s = a.sum(axis=1)
            a = a / s[:, None]
            alpha[lo:hi], scale[lo:hi] = a, s
        moves = np.zeros((k, k))
        beta = np.ones((0, k), dtype=np.float32)
        for t in range(len(alive) - 1, -1, -1):
            lo, hi, n = at[t], at[t + 1], alive[t]
            if len(beta):
                later = beta * emit[sym[hi:hi + len(beta)]] / scale[hi:hi + len(beta), None]
                moves += alpha[lo:lo + len(beta)].T @ later
                before = later @ move.T
            else:
                before = beta
            beta = np.ones((n, k), dtype=np.float32) if len(before) < n else before
            beta[:len(before)] = before
            alpha[lo:hi] *= beta                           # now the posterior of the state
        emits = np.stack([np.bincount(sym, weights=alpha[:, s], minlength=g) for s in range(k)], axis=1)
        return alpha[:len(lengths)].sum(axis=0, dtype=float) if len(alpha) else np.zeros(k), moves * self.move, emits


def start_model(rows: list[tuple], base: Base, model: Model) -> tuple[Params, np.ndarray, np.ndarray]:
    """From windows (word numbers, counts): parameters, the words and their
    expected counts.  Windows are clustered by their words, then Baum-Welch runs on
    them alone.  Without windows no word has a count in any state."""
    k, rng = model.states, np.random.default_rng(0)
    if not rows:
        return Params.estimate(np.zeros(k), rng.gamma(0.5, size=(k, k)), np.zeros(k), base, model.prior), np.zeros(0, np.int64), np.zeros((0, k))
    lengths = np.array([len(w) for w, _ in rows])
    wids, at, seq = np.unique(np.concatenate([w for w, _ in rows]), return_index=True, return_inverse=True)
    counts = np.concatenate([c for _, c in rows])[at]
    window = np.repeat(np.arange(len(rows)), lengths)
    post = rng.dirichlet(np.full(k, 0.5), len(rows))

    def estimated(start, move, expected):
        p = Params.estimate(start, move, expected.sum(axis=0), base, model.prior)
        return p, HMM(p, p.emissions(expected, counts))

    for _ in range(model.start_rounds):
        expected = np.stack([np.bincount(seq, post[window, s], len(wids)) for s in range(k)], axis=1)
        _, h = estimated(post.sum(axis=0), np.eye(k), expected)
        log = np.log(h.emit)
        z = np.stack([np.bincount(window, log[seq, s], len(rows)) for s in range(k)], axis=1) + np.log(post.mean(axis=0) + 1e-9)
        post = np.exp((z - z.max(axis=1, keepdims=True)) / 10)  # softened: long texts decide too early
        post /= post.sum(axis=1, keepdims=True)
    expected = np.stack([np.bincount(seq, post[window, s], len(wids)) for s in range(k)], axis=1)
    p, h = estimated(post.sum(axis=0), np.eye(k) * 200 + 1, expected)
    for _ in range(model.start_rounds):
        start, move, expected = h.expected(seq, lengths)
        p, h = estimated(start, move, expected)
    return p, wids, expected


def sampled(corpus: DataFrame, model: Model) -> list[tuple]:
    """Words and counts of the windows the first estimate is made of."""
    size = model.start_tokens
    there = corpus.select(F.explode(F.arrays_zip("held", "lengths")).alias("d")).filter(~F.col("d.held"))
    windows = there.agg(F.sum(F.ceil(F.col("d.lengths") / size))).first()[0] or 0
    share = min(1.0, 4 * model.start_docs / max(1, int(windows)))

    def some(b: pa.RecordBatch) -> dict:
        out: dict = {"hash": [], "w": [], "c": []}
        for row in b.to_pylist():
            tokens, at = unpacked(row["tokens"]), np.cumsum([0, *row["lengths"]])
            wids, counts = np.array(row["wids"]), np.array(row["counts"])
            for i in np.flatnonzero(~np.array(row["held"], dtype=bool)):
                for j in range(at[i], at[i + 1], size):
                    win = tokens[j:min(j + size, at[i + 1])]
                    key = hashlib.blake2b(f"{row['ids'][i]}:{j - at[i]}:".encode() + counts[win].tobytes(), digest_size=8).digest()
                    n = int.from_bytes(key, "little") >> 1
                    if n < share * 2**63:
                        out["hash"].append(n)
                        out["w"].append(wids[win])
                        out["c"].append(counts[win])
        return out

    got = (map_batches(corpus.select("ids", "held", "lengths", "tokens", "wids", "counts"), some, "hash bigint, w array<bigint>, c array<bigint>")
           .orderBy("hash", "w").limit(model.start_docs).collect())
    return [(np.array(r.w), np.array(r.c)) for r in got]


def release(*frames: DataFrame) -> None:
    """Remove stored steps that later ones replace, and let the shuffles behind them go."""
    for df in frames:
        Folder(df.sparkSession, df.inputFiles()[0].rsplit("/", 1)[0]).delete()
        gc.collect()
        time.sleep(1)  # the gateway lets go of the frames in a thread of its own
        df.sparkSession._jvm.System.gc()


# The table of expected counts: one row per bucket.  sums: of its words, by state.
EMITTED = "bucket bigint, wids binary, e binary, sums array<double>"
SHARED = 64  # rows that the starts and moves of all chunks are summed into


def emitted_row(bucket: int, wids: np.ndarray, expected: np.ndarray) -> dict:
    """A row of the table; sums are of the rounded counts."""
    e = pack_counts(expected)
    return {"bucket": bucket, "wids": pack_words(wids), "e": e,
            "sums": unpack(e, "<f4", expected.shape[1]).sum(axis=0, dtype=float).tolist()}


def by_word(emitted: DataFrame, states: int) -> DataFrame:
    """wid, e0, e1, ...: the table word by word."""
    names = [f"e{s}" for s in range(states)]

    def rows(b: pa.RecordBatch) -> dict:
        e = np.concatenate([unpack(x.as_py(), "<f4", states).reshape(-1, states) for x in b.column("e")])
        wids = np.concatenate([unpack_words(x.as_py()) for x in b.column("wids")])
        return {"wid": wids} | {c: e[:, s] for s, c in enumerate(names)}

    return map_batches(emitted.select("wids", "e"), rows, "wid bigint, " + ", ".join(f"{c} float" for c in names))


def each_chunk(corpus: DataFrame, columns: list[str], emitted: DataFrame, params: Params, buckets: int, fn, schema: str) -> DataFrame:
    """fn(row of the corpus, its HMM) -> columns, for every chunk once the
    expected counts of its words have been brought to it; `columns` of the
    corpus are what fn reads, with chunk, wids and counts."""
    shipped, k = corpus.sparkSession.sparkContext.broadcast(params), len(params.start)
    kinds = arrow_schema(schema)

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                wids = b.column("wids")[i].values.to_numpy()
                order, present, at = dealt(wids, buckets)
                asked = [pack_words(wids[order[lo:hi]]) for lo, hi in zip(at, at[1:])]
                yield pa.record_batch([pa.array([b.column("chunk")[i].as_py()] * len(present), pa.int64()), pa.array(present, pa.int64()),
                                       pa.array(asked, pa.binary())], names=["of", "bucket", "asked"])

    def answer(a: pa.Table, m: pa.Table) -> pa.Table:
        known, e = np.zeros(1, np.int64), np.zeros((1, k), np.float32)
        if m.num_rows:
            known, e = unpack_words(m["wids"][0].as_py()), unpack(m["e"][0].as_py(), "<f4", k).reshape(-1, k)
        out = []
        for asked in a["asked"]:
            wids = unpack_words(asked.as_py())
            at = np.minimum(np.searchsorted(known, wids), len(known) - 1)
            out.append(pack(np.where((known[at] == wids)[:, None], e[at], np.float32(0))))
        return pa.table({"of": a["of"], "bucket": a["bucket"], "e": pa.array(out, pa.binary())})

    def run(c: pa.Table, w: pa.Table) -> pa.Table:
        out = []
        w = w.sort_by("bucket")
        for i, row in enumerate(c.drop_columns(["wids", "counts"]).to_pylist()):
            row["wids"], row["counts"] = (c[f].combine_chunks()[i].values.to_numpy() for f in ("wids", "counts"))
            order, _, _ = dealt(row["wids"], buckets)
            expected = np.empty((len(order), k), np.float32)
            expected[order] = np.concatenate([unpack(x.as_py(), "<f4", k).reshape(-1, k) for x in w["e"]])
            h = HMM(shipped.value, shipped.value.emissions(expected, row["counts"]))
            cols = fn(row, h)
            out.append(pa.table([as_array(cols[f.name], f.type) for f in kinds], schema=kinds))
        return pa.concat_tables(out) if out else kinds.empty_table()

    asked = corpus.select("chunk", "wids").mapInArrow(ask, "of bigint, bucket bigint, asked binary")
    told = (asked.groupBy("bucket").cogroup(emitted.select("bucket", "wids", "e").groupBy("bucket"))
            .applyInArrow(answer, "of bigint, bucket bigint, e binary"))
    return corpus.select(columns).groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(run, schema)


def fit(corpus: DataFrame, base: Base, model: Model) -> tuple[Params, DataFrame, int]:
    """Baum-Welch over all training text: the parameters, the table of expected
    counts, summed across partitions, and its number of buckets.

    A bucket holds about `bucket_uses` uses of words and at least those of one
    word, at most one per chunk.  Starts and moves travel as words of negative
    numbers in buckets of their own, `SHARED` of them for all chunks."""
    spark, k, table = corpus.sparkSession, model.states, arrow_schema(EMITTED)
    uses = corpus.agg(F.sum(F.size("wids").cast("long"))).first()[0] or 0
    buckets = max(1, -(-int(uses) // model.bucket_uses))
    params, wids, expected = start_model(sampled(corpus, model), base, model)  # the words of a bounded sample
    order, present, at = dealt(wids, buckets)
    first = [emitted_row(int(b), wids[order[lo:hi]], expected[order[lo:hi]]) for b, lo, hi in zip(present, at, at[1:])]
    emitted = stored(spark.createDataFrame([tuple(r.values()) for r in first], EMITTED), "hmm", "emitted")

    def counts(row: dict, h: HMM) -> dict:
        lengths, keep = np.array(row["lengths"]), ~np.array(row["held"])
        seq = unpacked(row["tokens"])[np.repeat(keep, lengths)]
        if not len(seq):
            return {"bucket": [], "wids": [], "e": []}
        start, move, emits = h.expected(seq, lengths[keep])
        some = np.flatnonzero(emits.any(axis=1))
        own = row["wids"][some]
        order, present, at = dealt(own, buckets)
        cut = [order[lo:hi] for lo, hi in zip(at, at[1:])]
        share = np.vstack([start, move])[::-1]
        return {"bucket": [-1 - (row["chunk"] + (row["chunk"] >> 32)) % SHARED, *present],
                "wids": [pack_words(-1 - np.arange(k + 1)[::-1]), *[pack_words(own[i]) for i in cut]],
                "e": [pack(share.astype("<f4")), *[pack_counts(emits[some[i]]) for i in cut]]}

    def summed(t: pa.Table) -> pa.Table:
        wids = np.concatenate([unpack_words(x.as_py()) for x in t["wids"]])
        e = np.concatenate([unpack(x.as_py(), "<f4", k).reshape(-1, k) for x in t["e"]])
        words, at = np.unique(wids, return_inverse=True)
        total = np.stack([np.bincount(at, weights=e[:, s], minlength=len(words)) for s in range(k)], axis=1)
        return pa.Table.from_pylist([emitted_row(t["bucket"][0].as_py(), words, total)], schema=table)

    for _ in range(model.rounds):
        made = each_chunk(corpus, ["chunk", "held", "lengths", "tokens", "wids", "counts"], emitted, params, buckets, counts,
                          "bucket bigint, wids binary, e binary")
        last, emitted = emitted, stored(made.groupBy("bucket").applyInArrow(summed, EMITTED), "hmm", "emitted")
        del made
        shared = np.zeros((k + 1, k))
        for r in emitted.filter("bucket < 0").collect():  # at most SHARED rows of states + 1 words
            shared += unpack(r["e"], "<f4", k).reshape(-1, k)[::-1]
        emitted = emitted.filter("bucket >= 0")
        sums = emitted.agg(*[F.sum(F.get("sums", F.lit(s))).alias(f"s{s}") for s in range(k)]).first()
        params = Params.estimate(shared[0], shared[1:], np.array([x or 0.0 for x in sums]), base, model.prior)
        release(last)  # the small jobs above have taken the place of the round in what Spark still refers to
    return params, emitted, buckets


def train(corpus: DataFrame, base: Base, model: Model) -> tuple[Params, DataFrame]:
    """`fit`, with the expected counts word by word (wid, e0, e1, ...)."""
    params, emitted, _ = fit(corpus, base, model)
    return params, by_word(emitted, model.states)


SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def scores(docs: DataFrame, model: Model = Model(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    One row per input row, repeated rows included (each counts in training); a
    null or empty text is the end alone; a null id trains (its text is the
    empty string); an empty table gives no rows; without training text every
    score is 0; other columns are not looked at.  Ids are integers.
    """
    cut = stored(chunks(docs, model, id_col, text_col), "hmm", "cut")
    uses, base = counted(cut)
    corpus = stored(numbered(cut, uses, base), "hmm", "corpus")
    release(cut, uses)
    params, emitted, buckets = fit(corpus, base, model)
    trained = base.tokens

    def scored(row: dict, h: HMM) -> dict:
        lengths = np.array(row["lengths"])
        return {"doc_id": row["ids"], "held_out": row["held"], "n_tokens": row["lengths"], "n_known": row["known"],
                "train_tokens": [trained] * len(lengths), "base_score": row["base"],
                "score": h.log_likelihood(unpacked(row["tokens"]), lengths)}

    return each_chunk(corpus, ["chunk", "ids", "held", "lengths", "tokens", "known", "base", "wids", "counts"], emitted, params, buckets,
                      scored, SCORES).withColumnRenamed("doc_id", id_col)

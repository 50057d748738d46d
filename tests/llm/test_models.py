"""WARC archives, the language model, exact search, the pipeline."""

import base64
import glob
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lanecast.llm import hmm, vafile, warc
from lanecast.llm.catalog import WORD_BPE
from lanecast.llm.common import LOWER_AZ, stored
from lanecast.session import scratch_path
from tests.conftest import SF_SMALL


def archive(spark, rows, least=0):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    path = scratch_path(spark, "test", "warc")
    warc.write_archives(df, path, least)
    return path


def test_warc_round_trip(spark):
    rows = [(3, "http://a/\r\nx", "same"), (1, None, "same"), (2, "u", "same"), (5, "u", None), (4, "u", ""),
            (6, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 3), (7, "u", "é🙂" * 50_000), (None, "u", "same"), (None, "u", "lone"), (1, None, "same")]
    path = archive(spark, rows)
    got = {(r.page_id, r.payload_digest): r for r in warc.resolve(warc.read_records(spark, path)).collect()}
    assert len(got) == 9
    for i, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        r = got[i, digest]
        first = min((x for x, _, h in rows if (h or "") == (html or "") and x is not None), default=None)
        assert r.payload_bytes == len(data)
        assert (r.record_type, r.refers_to) == (("response", None) if i == first else ("revisit", first))
    records = spark.read.format("binaryFile").load(path + "/*.gz").collect()
    heads = [h for f in records for h, _ in warc.records(zlib.decompress(bytes(f.content), 31))]
    assert len(heads) == len(rows)
    named = {h["WARC-Record-ID"] for h in heads if h["WARC-Type"] == "response"}
    assert all(h["WARC-Refers-To"] in named for h in heads if h["WARC-Type"] == "revisit")


def test_warc_small_payloads_and_empty(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    got = {r.page_id: r.record_type for r in warc.resolve(warc.read_records(spark, archive(spark, rows, 4))).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.resolve(warc.read_records(spark, archive(spark, []))).count() == 0


def test_warc_damage_is_an_error():
    good = (warc.record(1, "u", "x", None, False, "2025-01-01T00:00:00Z") + warc.END).encode()
    assert len(list(warc.records(good * 2))) == 2
    with pytest.raises(ValueError):
        list(warc.records(good[:-6] + good))


def test_forward_is_exact_and_expected_counts_match():
    rng = np.random.default_rng(0)
    k, g = 3, 4
    params = hmm.Params(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), np.ones(k), hmm.Base(1, 1), 1.0)
    h = hmm.HMM(params, rng.dirichlet(np.ones(g), k).T)
    seqs = [[1, 0, 2, 3, 3], [2], [0, 1], [3, 2, 1]]
    lengths, flat = np.array([len(s) for s in seqs]), np.concatenate(seqs).astype(np.uint16)
    starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros((g, k))
    for s, log in zip(seqs, h.log_likelihood(flat, lengths)):
        paths = {p: h.start[p[0]] * math.prod(h.move[a, b] for a, b in zip(p, p[1:])) * math.prod(h.emit[x, a] for a, x in zip(p, s))
                 for p in itertools.product(range(k), repeat=len(s))}
        total = sum(paths.values())
        assert math.isclose(log, math.log10(total), rel_tol=1e-9)
        for p, n in paths.items():
            starts[p[0]] += n / total
            for a, b in zip(p, p[1:]):
                moves[a, b] += n / total
            for a, x in zip(p, s):
                emits[x, a] += n / total
    for mine, want in zip(h.expected(flat, lengths), (starts, moves, emits)):
        assert np.allclose(mine, want, atol=1e-4)


def test_model_is_a_distribution():
    """All words of the training text and the unseen type, in every state."""
    expected, base = np.random.default_rng(2).gamma(0.3, 20, size=(9, 2)), hmm.Base(90, 9)
    p = hmm.Params.estimate(np.ones(2), np.ones((2, 2)), expected.sum(axis=0), base, 1.5)
    emit = p.emissions(expected, np.full(9, 10))
    assert np.allclose(emit.sum(axis=0) + 1 / base.total, 1) and np.allclose(p.move.sum(axis=1), 1)
    assert (p.emissions(expected, np.zeros(9)) == 1 / base.total).all()


def test_every_word_has_its_own_emissions(spark):
    """A corpus of over 20,000 words: expected counts of each word add up to its
    count, and the scores are those of a forward recursion over plain dicts."""
    rng = random.Random(6)
    words = [[f"{v}{i}" for i in range(8000)] for v in "abc"]
    rows = [(i, " ".join(rng.choice(words[i % 3]) for _ in range(150))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    model = hmm.Model(states=3, chunk_tokens=7000, rounds=2)
    cut = hmm.stored(hmm.chunks(docs, model, "doc_id", "text"), "hmm")
    uses, base = hmm.counted(cut)
    corpus = hmm.stored(hmm.numbered(cut, uses, base), "hmm")
    params, emitted = hmm.train(corpus, base, model)
    names = {r.wid: (r.word, r.c) for r in cut.select(F.explode("words").alias("word"), "chunk").distinct().join(
        uses.join(cut.select("chunk", F.posexplode("words").alias("idx", "word")), ["chunk", "idx"]), ["chunk", "word"]).collect()}
    e = {names[r.wid][0]: np.array([r.e0, r.e1, r.e2]) for r in emitted.collect()}
    count = {w: c for w, c in names.values()}
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    assert count == Counter({w: 0 for w in count}) + Counter(w for i, t in rows if i not in held for w in [*t.split(), hmm.END]) | {w: 0 for w in count if not count[w]}
    assert len(e) > 15_000 and all(abs(e[w].sum() - c) < 1e-2 * max(1, c) for w, c in count.items() if c)
    q = (params.totals + 1) / (params.totals + 1).sum()

    def emission(w):
        if not count[w]:
            return np.full(3, 1 / base.total)
        return (1 - 1 / base.total) * (e[w] + q) / (params.totals + q * base.types)
    got = {r.doc_id: r for r in hmm.scores(docs, model).collect()}
    for i, t in rows[::25]:
        a, total = params.start, 0.0
        for j, w in enumerate([*t.split(), hmm.END]):
            a = (a if j == 0 else a @ params.move) * emission(w)
            total += math.log10(a.sum())
            a = a / a.sum()
        assert math.isclose(got[i].score, total, rel_tol=1e-5)
    assert all(got[i].score > got[i].base_score + 20 for i in held)  # the vocabularies are told apart


def test_scores(spark, odd, odd_rows, none):
    small = hmm.Model(states=2, chunk_tokens=5000, start_rounds=3)
    got = hmm.scores(odd, small).collect()
    assert len(got) == len(odd_rows) and hmm.scores(none, small).count() == 0
    table = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    tokens = [(i, [*(t or "").encode().translate(table).split(), None]) for i, t, *_ in odd_rows]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
                  for i, ws in tokens)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)


def test_held_out_score_beats_base(spark):
    """Two vocabularies that do not mix: the latent state has something to learn."""
    rng = random.Random(4)
    words = [[f"a{i}" for i in range(300)], [f"b{i}" for i in range(300)]]
    rows = [(i, " ".join(rng.choice(words[i % 2]) for _ in range(60))) for i in range(400)]
    got = hmm.scores(spark.createDataFrame(rows, "doc_id bigint, text string"), hmm.Model(states=2)).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 10 * len(held)


def test_long_documents_train_states(spark):
    """Only documents longer than a window of the first estimate: windows of them are its sample."""
    rng = random.Random(5)
    words = [[f"a{i}" for i in range(200)], [f"b{i}" for i in range(200)]]
    rows = [(i, " ".join(rng.choice(words[i % 2]) for _ in range(150))) for i in range(200)]
    how = hmm.Model(states=2, start_tokens=100, start_docs=64)
    held = [r for r in hmm.scores(spark.createDataFrame(rows, "doc_id bigint, text string"), how).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 20 * len(held)


def test_start_without_sample_has_unequal_states():
    params, wids, expected = hmm.start_model([], hmm.Base(90, 9), hmm.Model(states=3))
    assert len(wids) == 0 and expected.shape == (0, 3)
    assert len({tuple(r.round(6)) for r in params.move}) == 3
    assert np.allclose(params.emissions(np.zeros((2, 3)), np.array([4, 0])).sum(axis=1), [3 * 0.99 / 9, 0.03])


def brute_top(rows, k, every):
    seen = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(256 * float(np.float32(x))) for x in v]
            seen[i] = min(seen.get(i, q), q)
    out = []
    for q in sorted(seen):
        if q % every == 0:
            best = sorted(((sum(a * b for a, b in zip(seen[q], v)), i) for i, v in seen.items() if i != q), key=lambda s: (-s[0], s[1]))
            out += [(q, n + 1, i, s) for n, (s, i) in enumerate(best[:k])]
    return out


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 8).astype(np.float32)]) for i in range(400)]
    rows += [(1000 + i, rows[100][1]) for i in range(30)]                       # ties
    rows += [(2000, None), (2001, [None] * 8), (2002, [float("nan")] * 8), (2004, [float("inf")] * 8), (None, rows[0][1]),
             (2006, []), (2008, [1.0]), (2010, rows[7][1]), (2010, rows[8][1]), rows[50], rows[50]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit("own"))
    for how in (vafile.Search(), vafile.Search(block_rows=64, query_rows=3, cells=4), vafile.Search(k=500, every=200)):
        got = [tuple(r) for r in vafile.top_k(df, how).orderBy("query_id", "rank").collect()]
        assert got == brute_top(rows, how.k, how.every)
    assert vafile.top_k(df.limit(0)).count() == 0
    assert vafile.top_k(df.filter("vec_id = 50")).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.integers(-300, 300, (500, 16))
    va = vafile.VAFile(x, 8)
    q = rng.integers(-300, 300, (20, 16))
    assert (va.bounds(q.astype(float)) >= q @ x.T).all()


def test_pipeline(spark):
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, had = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in cp.STAGES[:-1]:
        path = scratch_path(spark, "test", name)
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert ids and set(ids) <= had
        had = set(ids)
    final = cp.STAGES[-1][1](spark, docs, SF_SMALL)
    rows = sorted(final.collect(), key=lambda r: r.position)
    written = pa.concat_tables([pq.read_table(f) for f in sorted(glob.glob(f"{path.removeprefix('file:')}/part-*"))]).to_pylist()
    library = Tokenizer.from_file(public_tokenizers.path(WORD_BPE))
    assert [r.position for r in rows] == list(range(len(written))) and [r.doc_id for r in rows] == [w["doc_id"] for w in written]
    for r, w in zip(rows, written):
        ids = library.encode(w["text"] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    whole = cp.run(spark, SF_SMALL)
    assert sorted(map(str, whole.select("doc_id", "n_tokens").collect())) == sorted(map(str, final.select("doc_id", "n_tokens").collect()))


def test_pipeline_filters_equal_brute_force(spark):
    """The two filtering stages, document by document in plain Python: what is
    kept, the texts that are left, and the one document of each near-copy group."""
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = stored(cp.quality_rules(spark, docs, SF_SMALL), "test")
    near = cp.near_duplicates(spark, kept, SF_SMALL)

    def words(t):
        return t.encode().split()

    def normal(line):
        return re.sub("[0-9]+", "0", line.strip(" \t\n\x0b\x0c\r").lower())

    rows = {r.doc_id: r for r in docs.collect()}
    held = defaultdict(set)
    for r in rows.values():
        for line in (r.text or "").split("\n"):
            if words(line):
                held[r.source, normal(line)].add(r.doc_id)
    want = {}
    for r in rows.values():
        text = r.text or ""
        w, lines = words(text), text.split("\n")
        wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        many = Counter(wins)
        covered = {i + j for i, x in enumerate(wins) if many[x] > 1 for j in range(5)}
        gone = [x for x in lines if words(x) and len(held[r.source, normal(x)]) > 20 and min(held[r.source, normal(x)]) != r.doc_id]
        n = sum(len(words(x)) for x in gone)
        if len(w) >= 10 and 100 * len(covered) <= 20 * len(w) and not (n and (len(w) - n) * 100 < len(w) * 20):
            want[r.doc_id] = "\n".join(x for x in lines if x not in gone) if gone else r.text
    assert {r.doc_id: r.text for r in kept.collect()} == want and want.keys() <= rows.keys()

    def bits(t):
        w = [x.translate(LOWER_AZ) for x in words(t)]
        h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints, root = {i: bits(t or "") for i, t in want.items()}, {i: i for i in want}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(sorted(want), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3:
            a, b = sorted((top(i), top(j)))
            root[b] = a
    assert {r.doc_id: r.text for r in near.collect()} == {i: want[i] for i in want if top(i) == i}


def test_pipeline_on_nothing(spark, odd, none):
    import corpus_pipeline as cp
    for start in (none, odd):
        docs = start.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in cp.STAGES:
            path = scratch_path(spark, "test", name)
            stage(spark, docs, "").write.parquet(path)
            docs = spark.read.parquet(path)

"""Fill-in-the-middle, Merkle manifest and quality classifier."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanecast.llm import catalog, fim, gam, merkle
from lanecast.llm.common import table
from tests.conftest import SF_CHECK, SF_SMALL


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---- fill-in-the-middle --------------------------------------------------------


def cut_by_hand(key, text):
    x = sha(f"1:{'' if key is None else key}")
    h = [int(x[i:i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    if not n or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_cuts_equal_slices():
    texts = ["", "x", "\n", "é🙂漢\r\n\x00", "<P>", "a <M> b", "<P <S <", "> S> <" * 30, "long " * 999]
    for run in (1, 2, 7, 1 << 18):
        cutter = fim.Cutter(fim.Fim(run=run))
        for t in texts:
            for key in [None, *range(-3, 60)]:
                assert cutter.cut(key, t) == cut_by_hand(key, t)


def test_other_units():
    words = fim.Cutter(fim.Fim(unit=r"\S+\s*|\s+", apply_percent=100, spm_percent=0, run=3))
    text = "  one two\nthree   four five"
    assert words.ends(text).tolist() == [2, 6, 10, 18, 23, 27]
    n, form, a, m, out = words.cut(5, text)
    assert (n, form) == (6, "psm") and {a, a + m} <= {0, 2, 6, 10, 18, 23, 27}
    assert fim.Cutter(fim.Fim(unit="[a-z]")).cut(5, "abc1") == (None, "plain", None, None, "abc1")
    assert fim.Cutter(fim.Fim(unit="[a-z]", run=2)).cut(5, "abc1") == (None, "plain", None, None, "abc1")
    assert fim.Cutter(fim.Fim(unit="[a-z]?", run=2)).ends("abc1") is None  # empty units never end a text


def test_text_beyond_one_run():
    text = "ab\ncé🙂" * 100_000
    n, form, a, m, out = fim.Cutter(fim.Fim()).cut(1, text)
    assert (n, form, a, m, out) == cut_by_hand(1, text)


def test_fim_frames(spark, odd, odd_rows, none):
    got = fim.digests(odd).collect()
    want = [(k, *cut_by_hand(k, t or "")) for k, t, *_ in odd_rows]
    assert sorted(map(str, map(tuple, got))) == sorted(str((*w[:5], sha(w[5]), sha(t or ""))) for w, (_, t, *_) in zip(want, odd_rows))
    rows = fim.transform(odd.withColumn("text", F.concat(F.lit("<S"), "text")))
    assert {r.text for r in fim.restore(rows).collect()} == {"" if t is None else f"<S{t}" for _, t, *_ in odd_rows}
    assert fim.digests(none).count() == 0


# ---- Merkle manifest -------------------------------------------------------------


def tree(nodes, arity):
    """Root and, for each leaf, the (before, after) texts of every level."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([sha("".join(level[i:i + arity])) for i in range(0, len(level), arity)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            a = i - i % arity
            path.append(("".join(level[a:i]), "".join(level[i + 1:a + arity])))
            i //= arity
        paths.append(path)
    return levels[-1][0], paths


def by_hand(rows, arity):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of documents rows."""
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def raised(r):
        hit = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        return (*r[:3], r[3] + 1, r[4]) if hit else r

    fields = [(i, s, g, n, t) for i, t, g, s, n in rows]
    groups = {}
    for r in fields:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]], arity) for g in names}
    root, tops = tree([trees[g][0] for g in names], arity)
    out = []
    for g, top in zip(names, tops):
        for r, path in zip(groups[g], trees[g][1]):
            h = leaf(raised(r))
            for a, b in path + top:
                h = sha(a + h + b)
            out.append((r[0], leaf(r), trees[g][0], root, sha("".join(a + b for a, b in path + top)), h, h == root))
    return out


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_equals_tree_by_hand(spark, odd, odd_rows, arity):
    got = merkle.checked(odd, merkle.Manifest(arity=arity)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, by_hand(odd_rows, arity)))


def test_manifest_of_few_rows(spark, odd, odd_rows, none):
    assert merkle.checked(none).count() == 0
    one = odd.filter("doc_id = 7")
    assert [tuple(r) for r in merkle.checked(one).collect()] == by_hand([r for r in odd_rows if r[0] == 7], 2)
    row = merkle.manifest(one).collect()[0]
    assert row.leaf == row.subroot == row.root == row.presented and row.path == []


def test_manifest_of_equal_rows(spark):
    """Many copies of one row share out over the range partitions."""
    row = (5, "same", "en", "a", 4)
    docs = spark.range(3000).select(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, (
        ("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")))])
    got = [tuple(r) for r in merkle.checked(docs).collect()]
    assert sorted(got) == sorted(by_hand([row] * 3000, 2))
    rows = spark.range(20_000).select(F.lit("x").alias("g"), F.lit(1).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else a table this small is one partition
    try:
        _, runs = merkle.in_order(rows, "g", ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert runs.agg(F.max("_rows")).first()[0] < 5_000


def test_changed_rows_are_found(spark):
    docs = table(spark, SF_SMALL, "documents")
    kept = {r.doc_id: r for r in merkle.manifest(docs).collect()}
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 3, F.concat("text", F.lit("."))).otherwise(F.col("text")))
    again = {r.doc_id: r for r in merkle.manifest(changed).collect()}
    assert {k for k in kept if kept[k].leaf != again[k].leaf} == {3}
    assert again[3].root != kept[3].root


# ---- quality classifier ------------------------------------------------------------


def test_measure_defined_for_all_texts():
    long = "x" * 300_000 + " " + "y z " * 60_000
    for t in ["", " \n\t", "one", "é", "\x00", "漢字🙂", "AAAA " * 100, "a\nb\na\n", long]:
        x = gam.measure(t)
        assert len(x) == len(gam.NAMES) and np.isfinite(x).all()
    assert gam.measure("") == [0.0] * len(gam.NAMES)
    named = dict(zip(gam.NAMES, gam.measure("Aa bb!! bb!! #1\nx\n\nx\n")))
    assert named["words"] == np.log1p(6) and named["lines"] == np.log1p(3)
    assert named["bangs"] == 4 / 6 and named["symbols"] == 1 / 6 and named["distinct_words"] == 4 / 6
    assert named["commonest_word"] == 2 / 6 and named["repeated_lines"] == pytest.approx(1 / 3)
    assert named["repeated_triples"] == 0 and dict(zip(gam.NAMES, gam.measure("a b c a b c")))["repeated_triples"] == 1 / 4


def test_scores_are_sums_of_tables():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, len(gam.NAMES))).round(2)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int)  # only the pair tells
    model = gam.fit_gam(x[:2000], y[:2000])
    assert (0, 1) in {(i, j) for i, j, _ in model.pairs}
    for row, odds in zip(x[2000:2050], model.log_odds(x[2000:2050])):
        place = lambda edges, v: sum(e <= v for e in edges)
        want = model.base + sum(t[place(model.edges[f], row[f])] for f, t in enumerate(model.tables))
        want += sum(t[place(model.coarse[i], row[i]), place(model.coarse[j], row[j])] for i, j, t in model.pairs)
        assert odds == pytest.approx(want)
    assert gam.area(model.probability(x[2000:]), y[2000:]) > 0.9
    again = gam.fit_gam(x[:2000][::-1], y[:2000][::-1])
    assert (again.probability(x) == model.probability(x)).all()


def test_tree_is_shallow_and_best():
    g = np.array([0, 0, 5, 5, 0, 0, -3.0, -3])
    step = gam.shallow_tree(g, np.ones(8) * 10, np.full(8, 10.0), gam.Fit())
    assert len(np.unique(step)) <= 4 and step[2] == step[3] > 0 > step[6] == step[7]


def test_area():
    assert gam.area(np.array([0.1, 0.4, 0.4, 0.8]), np.array([0, 1, 0, 1])) == 0.875


def test_classify_frames(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(1, 1, "x"), (6, 0, "x"), (None, 1, "x"), (4, None, "x"), (7, 5, "x"), (99, 0, "x")],
                                   "doc_id bigint, quality int, x string")
    got = gam.classify(odd, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    held = {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in range(1, 11)}
    assert {r.doc_id: r.held_out for r in got if r.doc_id} == held
    assert {r.score for r in gam.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert gam.classify(none, labels).count() == 0


def test_held_out_quality(spark):
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    rows = catalog.QUERIES["op13_quality_gam"](spark, SF_CHECK).filter("held_out").join(labels, "doc_id").collect()
    score, y = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    assert len(rows) > 50 and gam.area(score, y) > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    # labels of the held-out fold change nothing
    other = labels.withColumn("quality", F.when(gam.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in gam.classify(docs, other).collect()}
    assert all(a[r.doc_id] == r.score for r in rows)

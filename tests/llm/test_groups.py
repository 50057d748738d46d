"""Operators that compare documents: SimHash, repeated strings, quality, mixing."""

import hashlib
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lanecast.llm import components, mixing, quality, simhash, suffix
from lanecast.session import scratch_path
from tests.llm.conftest import SCHEMA


def frame(spark, texts, sources="ab"):
    return spark.createDataFrame([(i, t, "en", sources[i % len(sources)], 0) for i, t in enumerate(texts)], SCHEMA)


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def slow_fingerprint(text):
    table = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    w = text.encode().translate(table).split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint():
    for t in ("", " ", "One", "one two", "one two three", "A b C d a B c D " * 30, "é ü ß"):
        assert simhash.fingerprint(t) % (1 << 64) == slow_fingerprint(t)


def test_links_equal_brute_force(spark):
    """Clustered fingerprints, more than a shard holds, against all pairs."""
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([rng.integers(0, 1 << 63, 1500, dtype=np.uint64), *(
        c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (60, n)).astype(np.uint64), axis=1)
        for n, c in enumerate(np.repeat(centres, 2) , start=0) for n in [1 + n % 5])]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    links = simhash.edges(df, simhash.Near(shard_rows=150))
    got = {r.node: r.root for r in components.components(links).collect()}
    parent = np.arange(len(fps))
    for i in range(len(fps)):
        j = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3)
        simhash._join(parent, np.full(len(j), i), j)
    groups = defaultdict(set)
    for i, p in enumerate(parent.tolist()):
        groups[p].add(int(fps.view(np.int64)[i]))
    mine = defaultdict(set)
    for x in fps.view(np.int64).tolist():
        mine[got.get(x, x)].add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


def test_shard_that_no_vantage_point_splits():
    """Fingerprints equal in the half their tree is over: the same groups as brute
    force, memory in proportion at 50,000, planted neighbours found."""
    rng = np.random.default_rng(8)
    mask, reach = simhash.HALVES[1], 1

    def made(n):
        base = np.unique(rng.integers(0, 1 << 32, n, dtype=np.uint64)) | np.uint64(0xABCD << 40)
        flips = [sum(1 << int(b) for b in rng.choice(32, 1 + i % 4, replace=False)) for i in range(n // 10)]
        return base, base[:n // 10] ^ np.array(flips, dtype=np.uint64)

    base, near = made(1500)
    points = np.unique(np.concatenate([base, near]))
    home = rng.random(len(points)) < 0.8
    want = np.arange(len(points))
    for i in np.flatnonzero(home):
        j = np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 3)
        simhash._join(want, np.full(len(j), i), j)
    assert np.array_equal(simhash.links_within(points, home, mask, 3, reach), want)
    assert (want != np.arange(len(points))).sum() > 80

    base, near = made(50_000)
    points = np.unique(np.concatenate([base, near]))
    tracemalloc.start()
    root = simhash.links_within(points, np.ones(len(points), bool), mask, 3, reach)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    a, b = (root[np.searchsorted(points, p)] for p in (base[:len(near)], near))
    linked = np.bitwise_count(base[:len(near)] ^ near) <= 3
    assert linked.sum() > 3000 and (a == b)[linked].all()


def test_simhash_cases(odd, odd_rows, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    by = {(r.doc_id, r.fp): r.component_id for r in rows}
    empty = simhash.fingerprint("")
    assert {c for (i, f), c in by.items() if f == empty} == {3}  # nulls, empty and blank texts link
    assert by[2, simhash.fingerprint(odd_rows[0][1])] == 1 and by[10, simhash.fingerprint(odd_rows[10][1])] == 9
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 3, 6, 7, 8, 9} <= set(ids) and not {2, 4, 5, 10} & set(ids)
    assert simhash.near_duplicates(none).count() == simhash.deduplicate(none).count() == 0


def brute_repeats(rows, length):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode()))):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            gone[s:s + length] |= w in seen
            seen.add(w)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def repeats_of(df, how):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.removals(df, how).collect()), key=str)


def test_repeated_strings_equal_brute_force(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
    passages = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(4)]
    texts = []
    for i in range(90):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 30))) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passages)[rng.randrange(20):])
        texts.append(" ".join(parts))
    near = texts[5] * 3
    texts += [near[:500] + str(i) + near[500:] for i in range(20)] + [near, near, "x" * 900, "xy" * 300, "x" * 1000, "", "short"]
    df = frame(spark, texts).repartition(4)
    want = brute_repeats(list(enumerate(texts)), 100)
    for how in (suffix.Repeats(), suffix.Repeats(chunk_bytes=5000, bucket_anchors=200), suffix.Repeats(chunk_bytes=5000, frequent=3)):
        assert repeats_of(df, how) == want


def test_repeated_strings_cases(odd, odd_rows, none):
    assert repeats_of(odd, suffix.Repeats(length=40, gram=16)) == brute_repeats([r[:2] for r in odd_rows], 40)
    assert suffix.removals(none).count() == 0


def test_quality_repeated_words(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 1, 4, 5, 6, 9, 30, 200)] + ["a b c d e " * 2, "q " * 50]
    got = {r.doc_id: r for r in quality.verdicts(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        at = defaultdict(list)
        for j in range(len(w) - 4):
            at[tuple(w[j:j + 5])].append(j)
        covered = {p for v in at.values() if len(v) > 1 for j in v for p in range(j, j + 5)}
        assert got[i].n_repeat_words == len(covered) and got[i].n_words == len(w)


def test_quality_lines(spark):
    """A line of many documents goes from all but the first; documents of
    little else are rejected, copies among them but the one with the smallest id."""
    own = [" ".join(f"own{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j % 26)}{j // 26 * 'z'}" for j in range(30)) for i in range(60)]
    notice = "This notice   has quite a few words 123 and comes again"
    texts = [f"{o}\n{notice}" for o in own] + [notice + "\n" + "tail words"] * 1 + [own[0] + " unique copy"] * 30
    got = {r.doc_id: r for r in quality.verdicts(frame(spark, texts, "a")).collect()}
    assert got[0].removed_words == 0 and got[1].removed_words == 11
    assert all(got[i].kept for i in range(60)) and not got[60].kept and not got[60].base_failed
    assert got[61].kept and not any(got[i].kept for i in range(62, 91))


def test_quality_limit_is_absolute(spark):
    """A banner in 21 documents of a large host goes, one in 20 stays; ids count
    as documents, not rows or texts."""
    def own(i):
        return " ".join(f"w{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i // 100]}{'abcdefghijklmnopqrst'[j]}" for j in range(20))
    texts = [own(i) + ("\nbanner of the site" if i < 21 else "\nrarer banner of it" if i < 41 else "") for i in range(900)]
    df = frame(spark, texts, "a")
    got = {r.doc_id: r.removed_words for r in quality.verdicts(df.unionByName(df.filter("doc_id = 30"))).collect()}
    assert {i for i, n in got.items() if n} == set(range(1, 21)) and len(got) == 900


def test_quality_lines_leave_the_texts(spark):
    """Boilerplate goes from the accepted texts of its host but the first; other
    lines, blank ones and other hosts stay as they are."""
    own = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x{chr(97 + j)}" for j in range(25)) for i in range(60)]
    notice = "Shared Notice 12 of this site"
    texts = [f"{o}\n\n {notice}{i} \nlast line {chr(97 + i % 26)}{'z' * (i // 26)}\n" for i, o in enumerate(own)]
    rows = [(i, t, "en", None, 7) for i, t in enumerate(texts)] + [(100, texts[3], "en", "b", 7), (3, texts[3], "en", None, 7)]
    got = quality.accepted(spark.createDataFrame(rows, SCHEMA)).collect()
    want = [(i, t if i in (0, 100) else "\n".join(x for x in t.split("\n") if "Notice" not in x)) for i, t, *_ in rows]
    assert sorted((r.doc_id, r.text) for r in got) == sorted(want)


def test_quality_cases(odd, odd_rows, none):
    rows = quality.verdicts(odd).collect()
    assert len(rows) == len({r[:2] for r in odd_rows})
    by = {(r.doc_id, r.n_words): r for r in rows}
    assert by[3, 0].base_failed and by[6, 30_000].kept and by[8, 400].base_failed and by[1, 10].kept
    kept = quality.accepted(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 6}
    assert quality.verdicts(none).count() == quality.accepted(none).count() == 0


def test_quality_is_native(odd):
    plan = quality.verdicts(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def water(sizes, mix):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(order)}
    full, left = {}, mix.share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        level = left / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if level * weight[s] > mix.most * sizes[s]]
        if not over:
            return {**full, **{s: level * weight[s] for s in rest}}
        for s in over:
            full[s] = mix.most * sizes[s]
            left -= full[s]


def test_mix_targets_and_words(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * (1 + j % 5) for j in range(rng.randrange(0, 90))), "en", s, 0)
            for i, s in enumerate(rng.choices(["a", "b", "c", "d", None, "ä"], [60, 5, 5, 20, 3, 7], k=4000))]
    df = spark.createDataFrame(rows, SCHEMA)
    how = mixing.Mix()
    got = mixing.plan(df, how).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.src] += r.size
        taken[r.src] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * len(r.times) and all(0 <= t <= 1 for t in r.times)
    want = water(sizes, how)
    for r in got:
        assert abs(r.target - want[r.src]) < 1e-6 * max(1, want[r.src]) and r.source_size == sizes[r.src]
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 5 for s in sizes)
    again = mixing.plan(df.repartition(7), how).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_order_follows_schedule(spark):
    """Words of a falling source come early, of a rising one late."""
    df = frame(spark, ["one two three four five"] * 3000, "abc").withColumn("text", F.concat("text", F.lit(" "), F.col("doc_id").cast("string")))
    times = defaultdict(list)
    for r in mixing.plan(df, mixing.Mix(weights=(1.0, 1.0, 1.0))).collect():
        times[r.src] += r.times
    mean = {s: np.mean(t) for s, t in times.items()}
    assert abs(mean["a"] - (0.5 - 1 / 12)) < 0.01 and abs(mean["b"] - 0.5) < 0.01 and abs(mean["c"] - (0.5 + 1 / 12)) < 0.01


def test_positions_invert_the_demand_and_outlive_files(spark):
    """Positions are the words demanded before; rows written and read back in any
    split keep their place."""
    rng = random.Random(8)
    rows = [(i, f"d{i} " + "w " * rng.randrange(0, 60), "en", s, 0) for i, s in enumerate(rng.choices("abc", [6, 3, 1], k=3000))]
    df = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.plan(df).collect()
    target = {r.src: r.target for r in plan}
    slope = dict(zip("abc", mixing.Mix().slopes))
    for r in plan[::50]:
        for t, p in zip(r.times, r.positions):
            assert abs(p - sum(target[s] * ((1 - slope[s]) * t + slope[s] * t * t) for s in target)) < 1e-6 * max(1, p)
    want = [i for _, i in sorted((p, r.doc_id) for r in plan for p in r.positions)]
    path = scratch_path(spark, "test", "mixed")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    mixing.mix(df).write.option("maxRecordsPerFile", 500).parquet(path)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
        read = spark.read.parquet(path)
        got = mixing.in_order(read).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r.position for r in got) == list(range(len(want)))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.position)] == want
    assert {len(read.inputFiles()) > 4, read.columns == df.columns} == {True}


def test_repeated_rows_have_one_choice(spark):
    rows = [(1, "one two three", "en", "b", 5), (1, "one two three", "de", "a", 9), (1, "one two three", "de", "a", 10), (1, "one two three", "aa", None, 1)]
    got = [mixing.mix(spark.createDataFrame(r, SCHEMA)).distinct().collect() for r in (rows, rows[::-1])]
    assert got[0] == got[1] and [(r.source, r.lang, r.n_chars) for r in got[0]] == [("a", "de", 10)]


def test_mix_cases(odd, odd_rows, none):
    rows = mixing.plan(odd).collect()
    assert len(rows) == len({r[:2] for r in odd_rows} - {(3, None)} | {(3, "")} )
    out = mixing.mix(odd)
    assert out.columns == odd.columns and out.count() == sum(len(r.times) for r in rows)
    assert mixing.plan(none).count() == mixing.mix(none).count() == mixing.in_order(none).count() == 0
    assert sorted(r.position for r in mixing.in_order(odd.withColumn("position", F.lit("own"))).collect()) == list(range(len(odd_rows)))


def test_mix_fills_behind_a_long_document(spark):
    """A document that does not fit ends no source's remainder: what is left of
    the target is less than the smallest document not taken."""
    rng = random.Random(6)
    rows = [(i, "w " * 30_000, "en", "a", 0) for i in range(4)]
    rows += [(10 + i, f"x{i} " + "w " * rng.randrange(1, 40), "en", "a", 0) for i in range(3000)]
    rows += [(9000 + i, f"y{i} " + "w " * 50, "en", "b", 0) for i in range(800)]
    df = spark.createDataFrame(rows, SCHEMA)
    for how in (mixing.Mix(share=s, weights=(1.0, 2.0), bucket_rows=50) for s in (0.25, 1.5)):
        got = mixing.plan(df, how).collect()
        for src in "ab":
            own = [r for r in got if r.src == src]
            passes = own[0].target // own[0].source_size
            left = own[0].target - sum(r.taken for r in own)
            assert 0 <= left < min((r.size for r in own if len(r.times) == passes), default=left + 1)
            # one pass and the remainder lie end to end: no two documents overlap on the word line
            if how.share < 1 and passes == 0:
                t = lambda x: own[0].target * ((1 - slope) * x + slope * x * x)
                slope = how.slopes["ab".index(src)]
                mids = sorted((t(r.times[0]), r.size) for r in own if r.times)
                at = 0
                for mid, size in mids:
                    assert abs(mid - (at + size / 2)) < 0.01
                    at += size


def test_order_is_given_back_without_a_shuffle_of_the_rows(spark):
    """The files' row counts go to the rows, also where the planner broadcasts nothing."""
    path = scratch_path(spark, "test", "unshuffled")
    mixing.mix(spark.createDataFrame([(i, f"d{i} w w", "en", "a", 0) for i in range(50)], SCHEMA)).write.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = mixing.in_order(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

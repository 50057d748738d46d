"""Secret scan: patterns, and a character convolutional network over candidates.

Three patterns give the base findings (kept as they are).  Every other long
run of key-like characters that mixes letters and digits is a candidate too.
A small convolutional network in numpy reads each candidate with the text
around it and adds those it takes for secrets as spans of kind ``model``.

The network is trained here, on all distinct labelled windows of all documents:
validated base findings are secrets, all other candidates are not, nor are long
runs of letters alone.  Spark deals the windows out by their hash to shards; in
each of `Net.rounds` rounds every shard steps through all of its windows from the
same weights, and the means of the shards' weights start the next round.  A
held-out fifth calibrates the scores (Platt's scaling) and sets the threshold, both
from counts of all held-out windows by score: the largest score that keeps the
demanded recall, moved half way to the next non-secret below it.  Where labels
cannot be learnt that threshold is low and precision pays for recall; both are
reported with the spans.
"""

from __future__ import annotations

import copy
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.llm.common import hash_share, map_batches, stored, text_of

# Kinds in the order that breaks ties of start, their patterns
# and the least length of what must be long enough.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "model")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # of a run of hex characters, all or too short
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGIT, LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")

# Window: characters before, inside (long candidates have several) and after.
LEFT, INSIDE, RIGHT, WIDTH = 24, 48, 16, 5
SIZE = LEFT + INSIDE + RIGHT
CODES = 98  # 0 nothing, 1-95 printable ASCII, 96 control, 97 other


@dataclass(frozen=True)
class Net:
    """filters of the convolution; steps of training, at least, in all rounds;
    recall the threshold must keep; windows of a shard, about; sample_rows: for a
    trial, train on so many windows of each label only (None: on all)."""

    sample_rows: int | None = None
    filters: int = 24
    steps: int = 1000
    recall: float = 0.98
    rounds: int = 4
    shard_rows: int = 10_000


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) by the patterns, by start and kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", *m.span(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", *m.span(), m.start()) for m in HEX.finditer(text)]
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def other_candidates(text: str, base: list[tuple], letters: bool = False) -> list[tuple[int, int]]:
    """Key-like runs with letters and digits that touch no base span; with
    `letters`, also those without a digit."""
    runs = [(a, b) for a, b in (m.span() for m in RUN.finditer(text))
            if (LETTER.search(text, a, b) if DIGIT.search(text, a, b) else letters)]
    if base and runs:
        ends = np.maximum.accumulate([s[2] for s in base])  # base is by start
        starts = [s[1] for s in base]
        runs = [(a, b) for a, b in runs
                if (k := int(np.searchsorted(starts, b))) == 0 or ends[k - 1] <= a]
    return runs


def windows(text: str, start: int, end: int) -> list[bytes]:
    """Codes of the candidate with its context, SIZE each; the candidate is read to its end."""
    out = []
    for a in range(start, max(end, start + 1), INSIDE):
        b = min(a + INSIDE, end)
        left, right = text[max(0, a - LEFT):a], text[b:b + RIGHT]
        out.append(_codes(left).rjust(LEFT, b"\0") + _codes(text[a:b]).ljust(INSIDE, b"\0") + _codes(right).ljust(RIGHT, b"\0"))
    return out


def _codes(s: str) -> bytes:
    return bytes(o - 31 if 32 <= o <= 126 else 96 if o < 128 else 97 for o in map(ord, s))


REGIONS = ((0, LEFT), (LEFT, LEFT + INSIDE), (LEFT + INSIDE, SIZE))


class CharCNN:
    """Convolution over characters, ReLU, largest value in each region, logistic unit."""

    def __init__(self, filters: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.w = rng.normal(0, 0.1, (WIDTH, CODES, filters)).astype(np.float32)
        self.w[:, 0] = 0
        self.b = np.zeros(filters, dtype=np.float32)
        self.v = rng.normal(0, 0.1, len(REGIONS) * filters).astype(np.float32)
        self.c = np.float32(0)
        self.scale, self.shift, self.threshold = 1.0, 0.0, 2.0
        self.recall = self.precision = None  # on the held-out windows

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, pooled values and where they are largest; x: n x SIZE codes."""
        n, f = len(x), len(self.b)
        padded = np.pad(x, ((0, 0), (WIDTH // 2, WIDTH // 2)))
        h = np.zeros((n, SIZE, f), dtype=np.float32)
        for k in range(WIDTH):
            h += self.w[k][padded[:, k:k + SIZE]]
        h += self.b
        at = np.stack([h[:, a:b].argmax(axis=1) + a for a, b in REGIONS], axis=1)      # n, regions, f
        top = np.take_along_axis(h, at.reshape(n, -1, f), axis=1).reshape(n, -1)
        pooled = np.maximum(top, 0)
        return pooled @ self.v + self.c, pooled, at

    def step(self, x: np.ndarray, y: np.ndarray, rate: float) -> None:
        z, pooled, at = self.forward(x)
        g = (1 / (1 + np.exp(-z)) - y) / len(x)
        gp = (g[:, None] * self.v) * (pooled > 0)
        self.v -= rate * (pooled.T @ g + 1e-4 * self.v)
        self.c -= np.float32(rate * g.sum())
        n, f = len(x), len(self.b)
        gp = gp.reshape(n, len(REGIONS), f)
        self.b -= rate * gp.sum(axis=(0, 1))
        padded = np.pad(x, ((0, 0), (WIDTH // 2, WIDTH // 2)))
        cols = np.broadcast_to(np.arange(f), at.shape)
        for k in range(WIDTH):
            code = np.take_along_axis(padded, (at + k).reshape(n, -1), axis=1).reshape(at.shape)
            np.add.at(self.w[k], (code, cols), (-rate * gp).astype(np.float32))
        self.w[:, 0] = 0

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of being a secret."""
        z = np.concatenate([self.forward(x[i:i + 256])[0] for i in range(0, len(x), 256)]) if len(x) else np.zeros(0)
        return self.calibrated(z)

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -60, 60)))

    def weights(self) -> np.ndarray:
        return np.concatenate([self.w.ravel(), self.b, self.v, [self.c]]).astype(np.float64)

    def put(self, flat: np.ndarray) -> None:
        at = np.cumsum([self.w.size, self.b.size, self.v.size])
        w, b, v, c = np.split(flat.astype(np.float32), at)
        self.w, self.b, self.v, self.c = w.reshape(self.w.shape), b, v, np.float32(c[0])


def fit(x: np.ndarray, y: np.ndarray, net: Net) -> CharCNN:
    """Train, calibrate and set the threshold.  Every fifth window of a label
    is held out; a label of fewer than five windows is judged by those it was
    trained on.  Without both labels nothing is learnt and nothing ever added."""
    model = CharCNN(net.filters)
    if not 0 < y.sum() < len(y):
        return model
    rng = np.random.default_rng(1)
    held, judged = np.zeros(len(y), dtype=bool), np.zeros(len(y), dtype=bool)
    for label in (0, 1):
        at = np.flatnonzero(y == label)
        held[at[4::5]] = True
        judged[at[4::5] if len(at) >= 5 else at] = True
    train = np.flatnonzero(~held)
    for step in range(net.steps):
        part = rng.choice(train, min(32, len(train)), replace=False)
        model.step(x[part], y[part].astype(np.float32), 0.5 / (1 + 3 * step / net.steps))
    z, t = model.forward(x[judged])[0].astype(float), y[judged]
    judge(model, z, t, np.ones(len(z)), net)
    return model


def judge(model: CharCNN, z: np.ndarray, t: np.ndarray, n: np.ndarray, net: Net) -> None:
    """Calibrate and set threshold, recall and precision from held-out logits z
    with labels t, n windows each; both labels occur."""
    a, b = 1.0, 0.0
    for _ in range(500):
        g = n * (1 / (1 + np.exp(-np.clip(a * z + b, -60, 60))) - t)
        a, b = a - 0.05 * (g @ z) / n.sum(), b - 0.05 * g.sum() / n.sum()
    model.scale, model.shift = max(a, 1e-3), b
    p = model.calibrated(z)
    order = np.argsort(p, kind="stable")
    order = order[t[order] == 1]
    seen = n[order].cumsum()
    limit = float(p[order][np.searchsorted(seen, int((1 - net.recall) * seen[-1]), "right")])
    below = p[(t == 0) & (p < limit)]
    model.threshold = (limit + float(below.max(initial=0.0))) / 2
    found = p >= model.threshold
    model.recall, model.precision = float(n[found & (t == 1)].sum() / n[t == 1].sum()), float(n[found & (t == 1)].sum() / n[found].sum())


def labelled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """label (1: base finding), window (codes): one row per window of every candidate."""
    def run(b: pa.RecordBatch) -> dict:
        out: dict = {"label": [], "win": []}
        for t in b.column(0).to_pylist():
            base = base_spans(t)
            spots = [(1, s[3], s[2]) for s in base] + [(0, *c) for c in other_candidates(t, base, True)]
            for label, start, end in spots:
                got = windows(t, start, end)
                out["win"] += got
                out["label"] += [label] * len(got)
        return out

    return map_batches(docs.select(text_of(text_col).alias("text")), run, "label int, win binary")


def train(docs: DataFrame, net: Net = Net(), text_col: str = "text") -> CharCNN:
    """The network of all distinct labelled windows of docs; copies teach once.
    Without both labels nothing is learnt and nothing ever added."""
    rows = stored(labelled(docs, text_col).distinct(), "secrets")
    n = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if net.sample_rows is not None:
        return fit(*_sample(rows, n, net), net)
    model = CharCNN(net.filters)
    if len(n) < 2:
        return model
    held = F.pmod(F.xxhash64("win"), F.lit(5)) == 4
    parted = {r.label for r in rows.groupBy("label").agg(F.count_if(held).alias("h"), F.count_if(~held).alias("t")).collect() if r.h and r.t}
    both = ~F.col("label").isin(list(parted))  # too few windows to hold some out: all teach and judge
    train_rows(model, rows.filter(~held | both), sum(n.values()), net)
    # counts by score, to three decimals: at most some 60,000 rows however many windows
    counts = logits(rows.filter(held | both), model).groupBy("label", F.floor(F.col("z") * 1000).alias("z")).count().orderBy("label", "z").collect()
    judge(model, np.array([r.z for r in counts]) / 1000, np.array([r.label for r in counts]), np.array([r["count"] for r in counts], dtype=float), net)
    return model


def train_rows(model: CharCNN, rows: DataFrame, total: int, net: Net) -> None:
    """Rounds of training on (label, win) rows: shards by hash step through their
    windows from the same weights, which are then averaged by window."""
    shards = min(64, -(-total // net.shard_rows))  # their weights come to the driver, 50 KB each
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("win", F.lit(1)), F.lit(shards)).cast("int"))
    for round_ in range(net.rounds):
        shipped = rows.sparkSession.sparkContext.broadcast(model)

        def run(group: pa.Table) -> pa.Table:
            wins, labels = group.column("win").to_pylist(), group.column("label").to_numpy()
            order = sorted(range(len(wins)), key=lambda i: (wins[i], labels[i]))
            x = np.frombuffer(b"".join(wins[i] for i in order), dtype=np.uint8).reshape(-1, SIZE)
            mine = copy.deepcopy(shipped.value)
            whole_pass(mine, x, labels[order], round_, net)
            return pa.table({"shard": group.column("shard")[:1], "n": pa.array([len(x)], pa.int64()), "flat": pa.array([mine.weights()], pa.list_(pa.float64()))})

        made = sorted(dealt.groupBy("shard").applyInArrow(run, "shard int, n bigint, flat array<double>").collect())
        model.put(np.average([r.flat for r in made], axis=0, weights=[r.n for r in made]))
        shipped.unpersist()


def whole_pass(model: CharCNN, x: np.ndarray, y: np.ndarray, round_: int, net: Net) -> None:
    """Steps of a round, each on 16 windows of either label (32 where a shard has
    one): once through all windows at least, the fewer label's again and again."""
    rng = np.random.default_rng(round_)
    labels = [np.flatnonzero(y == v) for v in (0, 1) if (y == v).any()]
    size = 32 // len(labels)
    steps = max(-(-max(map(len, labels)) // size), -(-net.steps // net.rounds))
    turns = [np.concatenate([rng.permutation(at) for _ in range(-(-steps * size // len(at)))]) for at in labels]
    done = round_ / net.rounds
    for k in range(steps):
        part = np.concatenate([t[k * size:(k + 1) * size] for t in turns])
        model.step(x[part], y[part].astype(np.float32), 0.5 / (1 + 3 * (done + k / steps / net.rounds)))


def logits(rows: DataFrame, model: CharCNN) -> DataFrame:
    """label, z: the network's logit of each window, at most 30 either way."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> dict:
        x = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.uint8).reshape(-1, SIZE)
        return {"label": b.column(0), "z": np.clip(shipped.value.forward(x)[0].astype(float), -30, 30)}

    return map_batches(rows.select("label", "win"), run, "label int, z double")


def _sample(rows: DataFrame, n: dict[int, int], net: Net) -> tuple[np.ndarray, np.ndarray]:
    """The windows of the smallest hashes, sample_rows of each label: for trials."""
    xs, ys = [], []
    for label in (0, 1):
        some = hash_share(F.col("win"), 4 * net.sample_rows, n.get(label, 0))
        got = (rows.filter((F.col("label") == label) & some).select("win")
               .orderBy(F.xxhash64("win"), "win").limit(net.sample_rows).collect())
        xs += [bytes(r.win) for r in got]
        ys += [label] * len(got)
    return np.frombuffer(b"".join(xs), dtype=np.uint8).reshape(-1, SIZE), np.array(ys)


def find_all(texts: list[str], model: CharCNN) -> list[list[tuple[str, int, int]]]:
    """Base and model spans of each text, by start and kind."""
    out, spots, wins, owner = [], [], [], []
    for i, t in enumerate(texts):
        base = base_spans(t)
        out.append([s[:3] for s in base])
        for a, b in other_candidates(t, base):
            got = windows(t, a, b)
            owner += [len(spots)] * len(got)
            wins += got
            spots.append((i, a, b))
    if spots:
        p = model.probability(np.frombuffer(b"".join(wins), dtype=np.uint8).reshape(-1, SIZE))
        best = np.zeros(len(spots))
        np.maximum.at(best, owner, p)
        for (i, a, b), q in zip(spots, best.tolist()):
            if q >= model.threshold:
                out[i].append(("model", a, b))
    return [sorted(s, key=lambda x: (x[1], KINDS.index(x[0]))) for s in out]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, model: CharCNN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, n_<kind> of the base kinds, base_sha256, spans, n_model, and the
    model's held-out recall and precision (null if nothing was learnt).

    One row per input row, repeated rows included; null and empty texts have
    no spans; a null id stays null; other columns are not looked at; an empty
    table trains nothing and gives no rows.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # 50 KB

    def run(b: pa.RecordBatch) -> dict:
        found = find_all(b.column(1).to_pylist(), shipped.value)
        base = [[s for s in f if s[0] != "model"] for f in found]
        return {id_col: b.column(0), **{f"n_{k}": [sum(s[0] == k for s in f) for f in base] for k in BASE},
                "base_sha256": [hashlib.sha256(joined(f).encode()).hexdigest() for f in base],
                "spans": [joined(f) for f in found],
                "n_model": [len(f) - len(g) for f, g in zip(found, base)],
                "model_recall": [shipped.value.recall] * len(found), "model_precision": [shipped.value.precision] * len(found)}

    kind = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in BASE)
    return map_batches(docs.select(id_col, text_of(text_col).alias("text")), run,
                       f"`{id_col}` {kind}, {counts}, base_sha256 string, spans string, n_model bigint, model_recall double, model_precision double")


def redact(docs: DataFrame, model: CharCNN, text_col: str = "text") -> DataFrame:
    """docs with every span of its text replaced by [SECRET]; null stays null,
    all other columns and rows as they are."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text_col)

    def run(b: pa.RecordBatch) -> dict:
        texts = b.column(at).to_pylist()
        clean = [None if t is None else _without(t, s)
                 for t, s in zip(texts, find_all([t or "" for t in texts], shipped.value))]
        return {n: clean if i == at else b.column(i) for i, n in enumerate(names)}

    return map_batches(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def _without(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, done = [], 0
    for _, a, b in spans:
        if a >= done:
            out += [text[done:a], "[SECRET]"]
        done = max(done, b)
    return "".join([*out, text[done:]])

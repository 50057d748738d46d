"""Quality classifier: a generalised additive model with pairwise interactions.

A text is measured once, in numpy, by the numbers of `NAMES`; language, source
and id are no inputs.  Each number is cut into bins at quantiles, and the model
is one table of log-odds per number and one per chosen pair of numbers: a
score is a few look-ups and additions, done for a batch of rows at once.

Tables are learnt by cyclic boosting: in every round each number in turn gets a
tree of at most four leaves over its bins, fitted to what all tables so far
leave over, and a small step of it is added to its table.  The pairs that cut
the remaining error most (best pair of cuts over coarse bins) get tables in the
same way.  A held-out part of the sample stops either phase.

The fit reads a bounded sample (`Fit.sample_rows`) of distinct labelled
measurements; measuring and scoring are Spark jobs over all rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.llm.common import hash_share, map_batches, stored, text_of

NAMES = ("bytes", "words", "word_length", "longest_word", "short_words", "long_words", "letters", "upper", "digits",
         "space", "symbols", "bangs", "stops", "commas", "other_marks", "beyond_ascii", "entropy", "longest_run",
         "distinct_words", "commonest_word", "repeated_triples", "capital_words", "marked_words", "lines", "line_words",
         "repeated_lines")
SYMBOLS = list(b"#*$%&|<>")
OTHER_MARKS = [c for c in range(33, 127) if not chr(c).isalnum() and c not in [*SYMBOLS, *b"!.,"]]
WORD_BYTES = frozenset([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
CAPITALS = frozenset(range(65, 91))


@dataclass(frozen=True)
class Fit:
    """sample_rows: distinct labelled measurements to fit on, at most; bins of a
    number and of each side of a pair; pairs; rounds of either phase at most;
    rate of a step; least rows of a leaf; rounds without gain that end a phase."""

    sample_rows: int = 20_000
    bins: int = 32
    pair_bins: int = 8
    pairs: int = 10
    rounds: int = 300
    rate: float = 0.1
    leaf_rows: int = 5
    patience: int = 20
    ridge: float = 1.0


# ---- measuring ---------------------------------------------------------------


def measure(text: str) -> list[float]:
    """The numbers of NAMES over the whole text; zeros if it is empty."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(NAMES)
    data = np.frombuffer(raw, dtype=np.uint8)
    c = np.bincount(data, minlength=256)
    n, words = len(raw), raw.split()
    share = c[c > 0] / n
    ends = np.flatnonzero(np.diff(data))
    run = int(np.diff(ends, prepend=-1, append=n - 1).max())
    upper, lower = int(c[65:91].sum()), int(c[97:123].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    head = [np.log1p(n), np.log1p(len(words))]
    marks = [int(c[SYMBOLS].sum()), int(c[33]), int(c[46]), int(c[44]), int(c[OTHER_MARKS].sum())]
    w = max(1, len(words))
    if words:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(x, len(known)) for x in words), dtype=np.uint64, count=len(words))
        triples = (ids[:-2] * np.uint64(len(known)) + ids[1:-1]) * np.uint64(len(known)) + ids[2:]
        by_word = [size.mean(), np.log1p(size.max()), (size <= 2).mean(), (size >= 12).mean()]
        repeats = [len(known) / w, np.bincount(ids.astype(np.int64)).max() / w,
                   1 - len(np.unique(triples)) / len(triples) if len(triples) else 0.0,
                   sum(x[0] in CAPITALS for x in words) / w, sum(x[-1] not in WORD_BYTES for x in words) / w]
    else:
        by_word, repeats = [0.0] * 4, [0.0] * 5
    return [*map(float, [*head, *by_word, (upper + lower) / n, upper / max(1, upper + lower), c[48:58].sum() / n,
                         (c[9:14].sum() + c[32]) / n, *(k / w for k in marks), c[128:].sum() / n,
                         float(-(share * np.log2(share)).sum()), np.log1p(run), *repeats,
                         np.log1p(len(lines)), len(words) / max(1, len(lines)), 1 - len(set(lines)) / len(lines) if lines else 0.0])]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and `x`, the numbers of its text (a null text is empty)."""
    def run(b: pa.RecordBatch) -> dict:
        return {id_col: b.column(0), "x": [measure(t) for t in b.column(1).to_pylist()]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_of(text_col).alias("text")), run, f"`{id_col}` {kind}, x array<double>")


# ---- the model ---------------------------------------------------------------


@dataclass
class Gam:
    """Log-odds: base + tables[f][bin of f] + the pairs' tables."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            out += t[np.searchsorted(self.edges[f], x[:, f], "right")]
        for i, j, t in self.pairs:
            out += t[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -40, 40)))


def cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Edges of at most `bins` bins of about as many values each."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray, fit: Fit) -> tuple[float, int]:
    """Gain and place of the best cut of consecutive bins (place 0: none)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl, nl = g.cumsum()[:-1], h.cumsum()[:-1], n.cumsum()[:-1]
    gt, ht, nt = g.sum(), h.sum(), n.sum()
    gain = gl ** 2 / (hl + fit.ridge) + (gt - gl) ** 2 / (ht - hl + fit.ridge) - gt ** 2 / (ht + fit.ridge)
    gain[(nl < fit.leaf_rows) | (nt - nl < fit.leaf_rows)] = 0
    k = int(gain.argmax())
    return (float(gain[k]), k + 1) if gain[k] > 0 else (0.0, 0)


def shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, fit: Fit) -> np.ndarray:
    """Steps per bin (of one or two axes): a tree of depth two, at most four leaves."""
    out = np.zeros(g.shape)

    def grow(box: tuple[slice, ...], depth: int) -> None:
        gb, hb, nb = g[box], h[box], n[box]
        if depth:
            found = []
            for axis in range(gb.ndim):
                rest = tuple(a for a in range(gb.ndim) if a != axis)
                found.append((*best_cut(gb.sum(axis=rest), hb.sum(axis=rest), nb.sum(axis=rest), fit), axis))
            gain, at, axis = max(found, key=lambda x: x[0])
            if at:
                first = box[axis].start
                for part in (slice(first, first + at), slice(first + at, box[axis].stop)):
                    grow((*box[:axis], part, *box[axis + 1:]), depth - 1)
                return
        out[box] = gb.sum() / (hb.sum() + fit.ridge)

    grow(tuple(slice(0, k) for k in g.shape), 2)
    return out


def boost(columns: list[np.ndarray], shapes: list[tuple[int, ...]], score: np.ndarray, y: np.ndarray,
          held: np.ndarray, fit: Fit) -> list[np.ndarray]:
    """Cyclic boosting of one table per column of (flat) bins, on top of
    `score`; the tables of the round with the least held-out loss."""
    tables = [np.zeros(s) for s in shapes]
    score, train = score.copy(), ~held
    judge = held if held.any() else train
    best, kept, since = np.inf, [t.copy() for t in tables], 0
    for _ in range(fit.rounds):
        for f, (bins, shape) in enumerate(zip(columns, shapes)):
            p = 1 / (1 + np.exp(-score[train]))
            size, at = int(np.prod(shape)), bins[train]
            sums = [np.bincount(at, w, size).reshape(shape) for w in (y[train] - p, p * (1 - p), np.ones(len(at)))]
            step = fit.rate * shallow_tree(*sums, fit)
            tables[f] += step
            score += step.ravel()[bins]
        loss = float(np.logaddexp(0, np.where(y[judge] == 1, -score[judge], score[judge])).mean())
        if loss < best - 1e-5:
            best, kept, since = loss, [t.copy() for t in tables], 0
        elif (since := since + 1) >= fit.patience:
            break
    return kept


def pair_gain(a: np.ndarray, b: np.ndarray, shape: tuple[int, int], g: np.ndarray, h: np.ndarray, fit: Fit) -> float:
    """What the best cut of both sides at once (four quadrants) takes off the error."""
    at, size = a * shape[1] + b, shape[0] * shape[1]
    cum = [np.bincount(at, w, size).reshape(shape).cumsum(axis=0).cumsum(axis=1) for w in (g, h)]
    quadrants = []
    for c in cum:
        here, row, col, all_ = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        quadrants.append((here, row - here, col - here, all_ - row - col + here))
    return float(sum(q ** 2 / (r + fit.ridge) for q, r in zip(*quadrants)).max(initial=0.0))


def fit_gam(x: np.ndarray, y: np.ndarray, fit: Fit = Fit()) -> Gam:
    """The model of rows x and labels y (0, 1), the same for the same rows in
    any order.  Without both labels it is the share of ones, with one row of
    each label added; without rows one half.  Every sixth row of a label is
    held out; where no row is, the rows learnt from stop the rounds."""
    y = np.asarray(y, dtype=float)
    share = (y.sum() + 1) / (len(y) + 2)
    model = Gam(base=float(np.log(share / (1 - share))))
    if not 0 < y.sum() < len(y):
        return model
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order]
    held = np.zeros(len(y), dtype=bool)
    for label in (0, 1):
        held[np.flatnonzero(y == label)[3::6]] = True
    model.edges = [cuts(v, fit.bins) for v in x.T]
    model.coarse = [cuts(v, fit.pair_bins) for v in x.T]
    fine = [np.searchsorted(e, v, "right") for e, v in zip(model.edges, x.T)]
    rough = [np.searchsorted(e, v, "right") for e, v in zip(model.coarse, x.T)]
    score = np.full(len(y), model.base)
    model.tables = boost(fine, [(len(e) + 1,) for e in model.edges], score, y, held, fit)
    for f, t in enumerate(model.tables):  # centred: what all rows share is the base
        mean = float(t[fine[f]].mean())
        t -= mean
        model.base += mean
    score = model.log_odds(x)
    p = 1 / (1 + np.exp(-score[~held]))
    shape = [len(e) + 1 for e in model.coarse]
    gains = sorted(((pair_gain(rough[i][~held], rough[j][~held], (shape[i], shape[j]), y[~held] - p, p * (1 - p), fit), -i, -j)
                    for i in range(len(shape)) for j in range(i + 1, len(shape)) if shape[i] > 1 < shape[j]), reverse=True)
    chosen = [(-i, -j) for _, i, j in gains[:fit.pairs]]
    found = boost([rough[i] * shape[j] + rough[j] for i, j in chosen], [(shape[i], shape[j]) for i, j in chosen], score, y, held, fit)
    model.pairs = [(i, j, t) for (i, j), t in zip(chosen, found)]
    return model


def area(score: np.ndarray, y: np.ndarray) -> float:
    """Area under the ROC curve, ties half."""
    _, rank, n = np.unique(score, return_inverse=True, return_counts=True)
    mean = n.cumsum() - (n - 1) / 2
    yes = y == 1
    return float((mean[rank][yes].sum() - yes.sum() * (yes.sum() + 1) / 2) / max(1, yes.sum() * (~yes).sum()))


# ---- Spark -------------------------------------------------------------------


def train(rows: DataFrame, labels: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id", label_col: str = "quality") -> Gam:
    """The model of `measured` rows with the labels of their ids.

    Copies are made one before the sample is taken, so groups of copies of any
    size weigh as one text.  Null ids and labels other than 0 and 1 teach
    nothing; an id with both labels teaches both."""
    known = labels.filter(F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("int").alias("y")).distinct()
    pool = stored(rows.select(id_col, "x").distinct().join(known, id_col).select("x", "y").distinct(), "gam", "labelled")
    some = hash_share(F.array_join("x", " "), 2 * fit.sample_rows, pool.count())
    got = pool.filter(some).orderBy(F.xxhash64("x"), "x", "y").limit(fit.sample_rows).collect()  # bounded
    x = np.array([r.x for r in got], dtype=float).reshape(len(got), len(NAMES))
    return fit_gam(x, np.array([r.y for r in got]), fit)


def scored(rows: DataFrame, model: Gam, id_col: str = "doc_id", least: float = 0.7) -> DataFrame:
    """The id, score (0 to 1) and predicted of `measured` rows."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)  # a few tables of log-odds

    def run(b: pa.RecordBatch) -> dict:
        x = b.column(1).flatten().to_numpy().reshape(-1, len(NAMES))
        p = shipped.value.probability(x)
        return {id_col: b.column(0), "score": p, "predicted": (p >= least).astype(np.int32)}

    kind = rows.schema[id_col].dataType.simpleString()
    return map_batches(rows.select(id_col, "x"), run, f"`{id_col}` {kind}, score double, predicted int")


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2):
    """True for ids of the fold that teaches nothing; a null id is in none."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """The id, held_out, score, predicted: one row per row of docs.

    Labels teach only where their id is not held out.  Equal texts score
    alike; null and empty texts score by a measurement of zeros; an empty
    table gives no rows and a table without labels one half; other columns of
    either table are not looked at.
    """
    rows = stored(measured(docs, id_col, text_col), "gam", "measured")
    model = train(rows, labels.filter(~held_out(id_col)), fit, id_col, label_col)
    return scored(rows, model, id_col).select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")

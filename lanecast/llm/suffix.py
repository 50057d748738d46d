"""Removal of repeated byte strings by column-wise construction of a
collection's Burrows-Wheeler transform and common prefixes.

A byte goes if a string of `length` bytes that covers it also starts earlier
(smaller document, or the same one further left).

Documents are cut into chunks (one row, a compressed run of texts).  In each
window of `length` bytes the smallest hash of a `gram`-byte string, the
leftmost if tied, is the window's anchor: equal windows have equal anchors at
the same offset, so windows can be sorted out by anchor.

1. Chunks send their anchors, once each, to hash ranges, which answer with
   those that occur twice or more in the collection; likewise whole texts, of
   which all but the first are copies.
2. Chunks send the strings around these anchors (all windows an anchor stands
   for) to the hash range of the anchor.  Equal strings of a chunk are sent
   once, the later ones are marked at once.  An anchor with very many
   occurrences has its windows sent by their own hash, one by one, so that
   no task gets all strings of a frequent passage.
3. A range builds the transform of its collection column by column: strings
   with one anchor are aligned at it, and each round, from the last column to
   the first, puts one symbol in front of every string's suffix.  The symbols
   in suffix order are the round's part of the transform; a stable sort by them
   gives the next suffix order, and the common prefix of neighbours is one more
   than the least common prefix between them before.  Where neighbours share
   `length` symbols, windows are equal; all but the first in document order are marked.
4. Chunks gather their marks and remove the bytes under them.

The collection and what the rounds need lie in the shared folder and in
Spark's shuffle files, which are written and read sequentially.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.llm.common import arrow_schema, as_array, stored, text_of

CHUNKS = "chunk bigint, ids array<bigint>, lengths array<bigint>, texts binary"
PARCELS = "bucket bigint, chunk bigint, kind int, data binary"
ANSWERS = "chunk bigint, kind int, data binary"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"

DOC = np.dtype([("high", "<u8"), ("low", "<u8"), ("id", "<i8"), ("doc", "<i4")])
STRING = np.dtype([("key", "<u8"), ("id", "<i8"), ("hash", "<u8"), ("doc", "<i4"), ("start", "<i4"), ("left", "u1"), ("windows", "u1")])
MARK = np.dtype([("doc", "<i4"), ("first", "<i4"), ("last", "<i4")])  # windows that start from first to last
LAST_ID = np.iinfo(np.int64).max  # a null id comes last

ANCHORS, TEXTS, STRINGS, MARKS, REPEATED, FREQUENT, COPIES = range(7)


@dataclass(frozen=True)
class Repeats:
    """length: bytes of a repeated string; gram: bytes an anchor is the hash
    of; chunk_bytes: text of a chunk (about); bucket_anchors: anchors of a hash
    range (about); frequent: occurrences from which an anchor's windows are
    sent one by one."""

    length: int = 100
    gram: int = 32
    chunk_bytes: int = 16 << 20
    bucket_anchors: int = 100_000
    frequent: int = 100_000


def pack(a: np.ndarray) -> bytes:
    """Compressed records; bytes of one place lie together."""
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(raw.T).view(kind).reshape(-1)


def chunks(docs: DataFrame, how: Repeats, id_col: str, text_col: str) -> DataFrame:
    """Documents in chunks; inside a chunk by id and text hash."""
    schema = arrow_schema(CHUNKS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, rows, size = TaskContext.get().partitionId(), 0, [], 0

        def full() -> pa.RecordBatch:
            rows.sort(key=lambda r: (r[0] is None, r[0] or 0, xxhash.xxh64_intdigest(r[1])))
            texts = zstandard.ZstdCompressor(level=3).compress(b"".join(r[1] for r in rows))
            row = [[part << 32 | made], [[r[0] for r in rows]], [[len(r[1]) for r in rows]], [texts]]
            return pa.record_batch([as_array(c, f.type) for c, f in zip(row, schema)], schema=schema)

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows.append((i, t.encode()))
                size += len(rows[-1][1])
                if size >= how.chunk_bytes:
                    yield full()
                    made, rows, size = made + 1, [], 0
        if rows:
            yield full()

    return docs.select(F.col(id_col).cast("bigint"), text_of(text_col)).mapInArrow(run, CHUNKS)


class Chunk:
    """A chunk's documents: bytes, where they begin, order keys."""

    def __init__(self, row: dict):
        self.name = row["chunk"]
        self.ids = row["ids"]
        self.lengths = np.array(row["lengths"], dtype=np.int64)
        data = zstandard.ZstdDecompressor().decompress(row["texts"]) if sum(row["lengths"]) else b""
        self.bytes = np.frombuffer(data, np.uint8)
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.order = np.array([LAST_ID if i is None else i for i in self.ids], dtype=np.int64)
        self.hash = np.array([xxhash.xxh64_intdigest(self.text(d)) for d in range(len(self.ids))], dtype=np.uint64)

    def text(self, doc: int) -> bytes:
        return self.bytes[self.begin[doc]:self.begin[doc] + self.lengths[doc]].tobytes()

    def anchors(self, how: Repeats, slice_starts: int = 1 << 20) -> Iterator[tuple[np.ndarray, ...]]:
        """(document, first start, last start, anchor place, hash) arrays; starts and places in the chunk's bytes."""
        total = len(self.bytes)
        for a in range(0, max(0, total - how.length + 1), slice_starts):
            b = min(a + slice_starts, total - how.length + 1)
            grams = gram_hashes(self.bytes[a:b + how.length - 1], how.gram)
            key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
            place = (sliding_min(key, how.length - how.gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            starts = np.arange(a, b)
            doc = np.searchsorted(self.begin, starts, "right") - 1
            inside = starts + how.length <= self.begin[doc] + self.lengths[doc]
            starts, doc, place = starts[inside], doc[inside], place[inside]
            if len(starts):
                new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]))))
                last = np.concatenate((new[1:], [len(starts)])) - 1
                yield doc[new], starts[new], starts[last], place[new] + a, grams[place[new]]


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hash of each run of `gram` (a power of two) bytes."""
    v = BYTE[x]
    step = 1
    with np.errstate(over="ignore"):
        while step < gram:
            v = v[:-step] * np.uint64(pow(POINT, step, 1 << 64)) + v[step:]
            step *= 2
        v ^= v >> np.uint64(32)
        v *= np.uint64(POINT ^ 0x5555)
        v ^= v >> np.uint64(29)
        v *= np.uint64(POINT)
    return v


POINT = 0x9E3779B97F4A7C15
BYTE = np.random.default_rng(6).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[:len(v) - (width - have)], v[width - have:]) if have < width else v


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Range of a hash by its lower half (anchors are those of small upper halves)."""
    return ((key & np.uint64(0xFFFFFFFF)) * np.uint64(buckets)) >> np.uint64(32)


def parcels(chunk: int, kind: int, records: np.ndarray, key: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Records by the bucket of their key, one row for each that has any."""
    to = bucket_of(key, buckets)
    order = np.argsort(to, kind="stable")
    to = to[order]
    cuts = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if len(to) else []
    for a, b in zip(cuts, [*cuts[1:], len(to)]):
        yield int(to[a]), chunk, kind, pack(records[order[a:b]])


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """fn: a row as a dict to rows as tuples."""
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield from as_batches(fn(b.slice(i, 1).to_pylist()[0]), arrow)

    return df.mapInArrow(run, schema)


def as_batches(rows: Iterable[tuple], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while part := list(itertools.islice(rows, 256)):
        yield pa.record_batch([as_array(list(c), f.type) for c, f in zip(zip(*part), arrow)], schema=arrow)


def as_table(rows: Iterable[tuple], arrow: pa.Schema) -> pa.Table:
    return pa.Table.from_batches(as_batches(rows, arrow), schema=arrow)


def asked(cut: DataFrame, how: Repeats, buckets: int) -> DataFrame:
    """Anchors of a chunk with their counts, and the first of its equal texts."""
    pair = np.dtype([("key", "<u8"), ("n", "<u4")])

    def run(row: dict) -> Iterator[tuple]:
        c = Chunk(row)
        h = np.concatenate([np.zeros(0, np.uint64), *(x[4] for x in c.anchors(how))])
        key, n = np.unique(h, return_counts=True)
        records = np.empty(len(key), pair)
        records["key"], records["n"] = key, n
        yield from parcels(c.name, ANCHORS, records, key, buckets)
        firsts = [d for d in first_texts(c).values()]
        docs = np.empty(len(firsts), DOC)
        for i, d in enumerate(firsts):
            docs[i] = *text_key(c.text(d)), c.order[d], d
        yield from parcels(c.name, TEXTS, docs, docs["high"], buckets)

    return mapped(cut, run, PARCELS)


def text_key(text: bytes) -> tuple[int, int]:
    d = hashlib.md5(text, usedforsecurity=False).digest()
    return int.from_bytes(d[:8], "little"), int.from_bytes(d[8:], "little")


def first_texts(c: Chunk) -> dict:
    """First document of each text of the chunk."""
    out: dict = {}
    for d in range(len(c.ids)):
        out.setdefault(text_key(c.text(d)), d)
    return out


def answered(parcel: pa.Table, frequent: int) -> Iterator[tuple]:
    """To each chunk: its anchors that repeat, those that are frequent, its copies."""
    rows = parcel.to_pylist()
    asked_for = [(r["chunk"], unpack(r["data"], [("key", "<u8"), ("n", "<u4")])) for r in rows if r["kind"] == ANCHORS]
    if asked_for:
        key = np.concatenate([a["key"] for _, a in asked_for])
        uniq, at = np.unique(key, return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([a["n"] for _, a in asked_for]))[at]
        done = 0
        for chunk, a in asked_for:
            n = total[done:done + len(a)]
            done += len(a)
            for kind, some in ((REPEATED, a["key"][(n >= 2) & (n < frequent)]), (FREQUENT, a["key"][n >= frequent])):
                if len(some):
                    yield chunk, kind, pack(some)
    texts = [(r["chunk"], unpack(r["data"], DOC)) for r in rows if r["kind"] == TEXTS]
    if texts:
        docs = np.concatenate([a for _, a in texts])
        chunk = np.repeat([c for c, _ in texts], [len(a) for _, a in texts])
        order = np.lexsort((docs["doc"], chunk, docs["id"], docs["low"], docs["high"]))
        d = docs[order]
        copy = np.concatenate(([False], (d["high"][1:] == d["high"][:-1]) & (d["low"][1:] == d["low"][:-1])))
        for c in np.unique(chunk[order][copy]):
            yield int(c), COPIES, pack(d["doc"][copy & (chunk[order] == c)])


def of_kind(rows: list[dict], kind: int, dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *(unpack(r["data"], dtype) for r in rows if r["kind"] == kind)])


def strings(row: dict, answers: list[dict], how: Repeats, buckets: int) -> Iterator[tuple]:
    """Strings around the repeated anchors of a chunk, and marks of what repeats
    in the chunk itself; copies are marked whole.  Marks go to bucket -1."""
    c = Chunk(row)
    repeated, frequent = (np.sort(of_kind(answers, k, "<u8")) for k in (REPEATED, FREQUENT))
    copy = np.ones(len(c.ids), dtype=bool)
    copy[list(first_texts(c).values())] = False
    copy[of_kind(answers, COPIES, "<i4")] = True
    marks = [(d, 0, int(c.lengths[d]) - how.length) for d in np.flatnonzero(copy & (c.lengths >= how.length)).tolist()]
    data = c.bytes.tobytes()
    seen: set = set()
    heads, bodies = [], []
    for doc, first, last, place, h in c.anchors(how):
        often = isin_sorted(h, frequent)
        keep = np.flatnonzero((often | isin_sorted(h, repeated)) & ~copy[doc])
        for i, d, a, b, p, key in zip(keep.tolist(), *(x[keep].tolist() for x in (doc, first, last, place, h))):
            at = int(c.begin[d])
            if often[i]:
                todo = [(s, s, s) for s in range(a, b + 1)]
            else:
                todo = [(a, b, p)]
            for lo, hi, anchor in todo:
                s = data[lo:hi + how.length]
                if s in seen:
                    marks.append((d, lo - at, hi - at))
                    continue
                seen.add(s)
                heads.append((xxhash.xxh64_intdigest(s) if often[i] else key, c.order[d], c.hash[d], d, lo - at, anchor - lo, hi - lo + 1))
                bodies.append(s)
    yield -1, c.name, MARKS, pack(np.array(marks, MARK))
    head = np.array(heads, STRING)
    to = bucket_of(head["key"], buckets)
    order = np.argsort(to, kind="stable")
    for bucket, some in itertools.groupby(order.tolist(), key=lambda i: int(to[i])):
        some = list(some)
        body = zstandard.ZstdCompressor(level=1).compress(b"".join([bodies[i] for i in some]))
        packed = pack(head[some])
        yield bucket, c.name, STRINGS, len(packed).to_bytes(8, "little") + packed + body


def isin_sorted(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), dtype=bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def column_wise(head: np.ndarray, data: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """marked[string, window]: windows of the strings that are equal to one that
    starts earlier in document order.

    head: STRING records; string i is data[begin[i]:] with windows + length - 1 symbols.
    """
    m = len(head)
    size = head["windows"].astype(np.int64) + length - 1
    left = head["left"].astype(np.int64)
    when = np.empty(m, np.int64)  # rank in document order
    when[np.lexsort((head["start"], head["doc"], head["hash"], head["id"]))] = np.arange(m)
    group = np.unique(head["key"], return_inverse=True)[1]
    marked = np.zeros((m, int(head["windows"].max())), dtype=bool)
    ends = size - left                       # column after the last symbol, anchors at column 0
    order, common = np.zeros(0, np.int64), np.zeros(0, np.int64)
    by_end = np.argsort(-ends, kind="stable")
    entered = 0
    for column in range(int(ends.max()) - 1, -int(left.max()) - 1, -1):
        # strings whose last symbol is in this column begin with an empty suffix, first of their group
        fresh = entered
        while fresh < m and ends[by_end[fresh]] > column:
            fresh += 1
        # suffixes that go on: the others have no symbol left
        goes_on = left[order] >= -column
        least = running_min(common, goes_on)
        order = order[goes_on]
        new = by_end[entered:fresh]
        entered = fresh
        if len(new):
            both = np.concatenate((new, order))
            lcp = np.concatenate((np.zeros(len(new), np.int64), least))
            at = np.argsort(group[both], kind="stable")
            order, least = both[at], lcp[at]  # old strings that follow a new one were first of their group
        if not len(order):
            common = least
            continue
        symbols = data[begin[order] + column + left[order]]              # the transform's symbols of this round
        key = group[order] * 256 + symbols
        to = np.argsort(key, kind="stable")
        common = ranged_min(least, to)
        key, order = key[to], order[to]
        common[1:] = np.where(key[1:] == key[:-1], np.minimum(common[1:] + 1, length), 0)
        common[0] = 0
        if common.max() >= length:
            head_of = np.flatnonzero(common < length)
            run = np.cumsum(common < length) - 1
            first = np.minimum.reduceat(when[order], head_of)[run]
            later = order[when[order] != first]
            marked[later, column + left[later]] = True
    return marked


def running_min(common: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Common prefixes of the neighbours that are left when others go."""
    kept = np.flatnonzero(keep)
    if len(kept) < 2 or len(kept) == len(common):
        return common[:len(kept)] if len(kept) == len(common) else np.zeros(len(kept), np.int64)
    return np.concatenate(([0], np.minimum.reduceat(common[:kept[-1] + 1], kept[:-1] + 1)))


def ranged_min(v: np.ndarray, to: np.ndarray) -> np.ndarray:
    """For neighbours in the new order, the least of v between their old places
    (after the first, up to the second); for those that change sides, anything."""
    n = len(v)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    a, b = to[:-1] + 1, to[1:]
    span = np.maximum(b - a + 1, 1)
    level = np.frexp(span)[1] - 1
    tables, width = [v], 1
    for _ in range(int(level.max())):
        t = tables[-1]
        tables.append(np.minimum(t[:len(t) - width], t[width:]) if len(t) > width else t[:0])
        width *= 2
    for k, t in enumerate(tables):
        some = np.flatnonzero((level == k) & (a <= b))
        out[some + 1] = np.minimum(t[a[some]], t[b[some] - (1 << k) + 1])
    return out


def marks_of(parcel: pa.Table, how: Repeats) -> Iterator[tuple]:
    """Marks of a hash range, by chunk."""
    heads, bodies, chunk = [], [], []
    for r in parcel.to_pylist():
        n = int.from_bytes(r["data"][:8], "little")
        heads.append(unpack(r["data"][8:8 + n], STRING))
        bodies.append(zstandard.ZstdDecompressor().decompress(r["data"][8 + n:]))
        chunk += [r["chunk"]] * len(heads[-1])
    head = np.concatenate(heads)
    size = head["windows"].astype(np.int64) + how.length - 1
    marked = column_wise(head, np.frombuffer(b"".join(bodies), np.uint8), np.cumsum(size) - size, how.length)
    edge = np.diff(np.pad(marked, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    out = np.empty(len(row), MARK)
    out["doc"], out["first"], out["last"] = head["doc"][row], head["start"][row] + first, head["start"][row] + last
    owner = np.array(chunk)[row]
    for c in np.unique(owner):
        yield int(c), MARKS, pack(out[owner == c])


def without(row: dict, marks: list[dict], how: Repeats) -> Iterator[tuple]:
    """The result rows of a chunk."""
    c = Chunk(row)
    m = of_kind(marks, MARKS, MARK)
    m = m[np.lexsort((m["first"], m["doc"]))]
    cuts = np.searchsorted(m["doc"], np.arange(len(c.ids) + 1))
    for d, i in enumerate(c.ids):
        text, spans = c.text(d), []
        for first, last in zip(m["first"][cuts[d]:cuts[d + 1]].tolist(), m["last"][cuts[d]:cuts[d + 1]].tolist()):
            if spans and first <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], last + how.length)
            else:
                spans.append([first, last + how.length])
        kept, done = [], 0
        for a, b in spans:
            kept.append(text[done:a])
            done = b
        kept.append(text[done:])
        yield (i, len(text), sum(b - a for a, b in spans), len(spans), hashlib.sha256(b"".join(kept)).hexdigest(),
               [{"start": a, "end": b} for a, b in spans])


def removals(docs: DataFrame, how: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, n_bytes, n_removed, n_spans, kept_sha256 and spans (byte
    offsets): one row per input row.

    A null text is empty; a null id comes after all others; rows that repeat an
    id are documents of their own, ordered by a hash of their text, and of
    equal rows any one is the first; texts shorter than `length` bytes lose
    nothing; an empty table gives no rows; other columns are not looked at.
    Ids are integers.
    """
    cut = stored(chunks(docs, how, id_col, text_col), "suffix")
    size = cut.select(F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)"))).first()[0] or 0
    parcel_rows, answer_rows, result_rows = map(arrow_schema, (PARCELS, ANSWERS, RESULT))
    buckets = int(size * 2 // (how.length - how.gram + 2) // how.bucket_anchors) + 1

    def answer(t: pa.Table) -> pa.Table:
        return as_table(answered(t, how.frequent), answer_rows)

    def send(c: pa.Table, a: pa.Table) -> pa.Table:
        rows = a.to_pylist()
        return as_table((x for row in c.to_pylist() for x in strings(row, rows, how, buckets)), parcel_rows)

    def mark(t: pa.Table) -> pa.Table:
        return as_table(marks_of(t, how), answer_rows)

    def finish(c: pa.Table, a: pa.Table) -> pa.Table:
        rows = a.to_pylist()
        return as_table((x for row in c.to_pylist() for x in without(row, rows, how)), result_rows)

    answers = asked(cut, how, buckets).groupBy("bucket").applyInArrow(answer, ANSWERS)
    sent = stored(cut.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(send, PARCELS), "suffix")
    found = sent.filter(F.col("kind") == STRINGS).groupBy("bucket").applyInArrow(mark, ANSWERS)
    found = found.unionByName(sent.filter(F.col("kind") == MARKS).select("chunk", "kind", "data"))
    return (cut.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(finish, RESULT)
            .withColumnRenamed("doc_id", id_col))

"""BPE encoding and decoding with a tokenization automaton.

The automaton reads token labels.  It starts with one state in which every
base symbol loops.  Each merge (u, v) -> uv, taken in priority order, applies
one gadget: whoever has an arc u, if an arc v follows, gets an arc uv to the state that v leads to,
and the arcs u are sent to a copy of their target that has lost its arc v.
After the last merge the only label sequences left are exactly the
tokenizations the merges produce, one for each string.

Arcs with one label always share their target, so a state is named by the
label that leads to it and is stored as what the gadgets changed: the state it
was copied from (``base``, with the gadget number up to which the copy follows
it) and the arcs it lost (``lost``).  ``arc`` reads this table.

Encoding a pre-split word follows the arcs whose labels spell it; the path is
unique, so places that do not lead to the end are left once.  Decoding emits the labels of
the arcs, which for a vocabulary without decoder are joined by one space.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lanecast.llm.common import map_batches, text_of

# Fixed values of the vocabulary file's normaliser and splitter: NFC, lower
# case of single characters, and the classes of its split pattern.
PIECE = "'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^\\s{letter}{number}]+"
MARKS = ".,;:!?"
ODD_SPACE = "\x1c\x1d\x1e\x1f"  # str.split() takes these for space, the file's pattern does not

# Words a worker keeps with their encoding: a bound on memory, not on results;
# one more would double the table.
CACHE_WORDS = 2 ** 20 // 3
CACHE_WORD_CHARS = 64
LAST = 1 << 60


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: visible Latin-1
    characters stand for themselves, all others follow from U+0100 on."""
    shown = {b for r in ((33, 126), (161, 172), (174, 255)) for b in range(r[0], r[1] + 1)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else spare))
        spare += b not in shown
    return out


def char_class(major: str) -> str:
    """Ranges of the characters of a Unicode category, from Python's tables
    (the regex library's are of a later version)."""
    hits = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] == major]
    cuts = [i for i in range(1, len(hits)) if hits[i] != hits[i - 1] + 1]
    return "".join(f"\\U{hits[a]:08x}-\\U{hits[b - 1]:08x}" for a, b in zip([0, *cuts], [*cuts, len(hits)]))


def read_vocabulary(path: str) -> dict:
    """What the encoder needs of a tokenizer file: vocabulary, merges, the
    word-end mark and the special tokens.  Bounded by the file (2 MB)."""
    with open(path, encoding="utf-8") as f:
        return parse_vocabulary(f.read())


def parse_vocabulary(file: str) -> dict:
    """`read_vocabulary` of the text of a tokenizer file."""
    d = json.loads(file)
    return {"vocab": d["model"]["vocab"], "merges": [tuple(m) for m in d["model"]["merges"]],
            "end": d["model"]["end_of_word_suffix"],
            "special": {t["content"]: t["id"] for t in d["added_tokens"]}}


@dataclass
class Automaton:
    """Token states after all merge gadgets."""

    parts: dict[int, tuple[int, int, int]] = field(default_factory=dict)  # token: left, right, gadget
    lost: dict[int, int] = field(default_factory=dict)                    # state << 20 | arc: gadget
    arcs: dict[int, bool] = field(default_factory=dict)                   # arcs read so far
    dead: set[int] = field(default_factory=set)                           # labels on no path

    @classmethod
    def compile(cls, vocab: dict[str, int], merges: list[tuple[str, str]]) -> Automaton:
        a = cls()
        for step, (u, v) in enumerate(merges):
            a.gadget(step, vocab[u], vocab[v], vocab[u + v])
        return a

    def gadget(self, step: int, u: int, v: int, uv: int) -> None:
        if u in self.dead or v in self.dead or not self._arc(u, v):
            self.dead.add(uv)  # nothing leads from u to v: no path has the new label
            return
        if uv in self.parts:
            raise ValueError("two merges make one token")
        self.dead.discard(uv)
        self.parts[uv] = (u, v, step)   # state uv is a copy of state v as of this gadget
        self.lost[u << 20 | v] = step   # state u goes on without the arc v

    def arc(self, state: int, label: int) -> bool:
        """Whether the state has the arc: it was not lost by the state or by
        one it was copied from before the copy, nor was the arc of the left
        part from which a gadget made this label."""
        key = state << 20 | label
        got = self.arcs.get(key)
        if got is None:
            got = self._arc(state, label)
            if len(self.arcs) < 500_000:
                self.arcs[key] = got
        return got

    def _arc(self, state: int, label: int) -> bool:
        lost, parts, before = self.lost, self.parts, LAST
        while True:
            s, until = state, before
            while True:
                if lost.get(s << 20 | label, LAST + 1) <= until:
                    return False
                p = parts.get(s)
                if p is None:
                    break
                s, until = p[1], min(until, p[2] - 1)
            p = parts.get(label)
            if p is None:
                return True
            label, before = p[0], min(before, p[2])


class Encoder:
    """Text to token ids; one per worker, built from `read_vocabulary`."""

    def __init__(self, files: dict):
        vocab, end, self.special = files["vocab"], files["end"], files["special"]
        self.auto = Automaton.compile(vocab, files["merges"])
        self.root: dict = {}  # character: [characters that follow, token that ends inside, token that ends a word]
        for s, i in vocab.items():
            if i in self.auto.dead:
                continue
            last = s.endswith(end)
            follow, node = self.root, None
            for c in s.removesuffix(end) if last else s:
                node = follow.setdefault(c, [{}, None, None])
                follow = node[0]
            if node:
                node[2 if last else 1] = i
        self.bytes = dict(enumerate(byte_alphabet()))
        self.digits = {i: str(i) for i in {*vocab.values(), *self.special.values()}}
        self.piece = regex.compile(PIECE.format(letter=char_class("L"), number=char_class("N")))
        self.space = regex.compile(r"\s+")
        self.mark = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        self.label = labels_of(files)
        self.cache: dict[str, str] = {}   # runs as written
        self.pieces: dict[str, str] = {}  # pre-split words

    def word(self, chars: str) -> list[int]:
        """Token ids of one pre-split word in the byte alphabet.

        Follows arcs from the start, the longest label first.  A prefix has one
        tokenization, so a place from which the end is not reached never is."""
        n, arcs, arc, root = len(chars), self.auto.arcs, self.auto.arc, self.root
        path: list = []
        dead: set = set()
        at, state, labels = 0, -1, None
        while at < n:
            if labels is None:  # spelled from here on, the longest last
                labels, follow = [], root
                for j in range(at, n):
                    node = follow.get(chars[j])
                    if node is None:
                        break
                    follow, t, final = node
                    if j + 1 == n:
                        t = final
                    if t is not None:
                        labels.append((j + 1, t))
            while labels:
                end, t = labels.pop()
                if end in dead:
                    continue
                if at:
                    ok = arcs.get(state << 20 | t)
                    if not (arc(state, t) if ok is None else ok):
                        continue
                path.append((at, state, labels, t))
                at, state, labels = end, t, None
                break
            else:
                dead.add(at)
                at, state, labels, _ = path.pop()
        return [p[3] for p in path]

    def text_piece(self, piece: str) -> str:
        """Ids of a pre-split word, joined by one space."""
        got = " ".join([self.digits[i] for i in self.word(piece.encode().decode("latin-1").translate(self.bytes))])
        if len(self.pieces) < CACHE_WORDS and len(piece) <= CACHE_WORD_CHARS:
            self.pieces[piece] = got
        return got

    def chunk(self, chunk: str) -> str:
        """Ids, joined by one space, of a run without space."""
        s = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        pieces = self.pieces
        if s.isalpha():  # only letters
            split = (s,)
        elif s[:-1].isalpha() and s[-1] in MARKS:
            split = (s[:-1], s[-1])
        else:
            split = self.piece.findall(s)
        parts = [pieces.get(p) or self.text_piece(p) for p in split]
        got = parts[0] if len(parts) == 1 else " ".join(parts)
        if len(self.cache) < CACHE_WORDS and len(chunk) <= CACHE_WORD_CHARS:
            self.cache[chunk] = got
        return got

    def encode(self, text: str) -> str:
        """Ids of a text, joined by one space."""
        ids, cache = [], self.cache
        for part in self.mark.split(text) if self.mark and "<|" in text else (text,):
            if part in self.special:
                ids.append(str(self.special[part]))
                continue
            odd = any(c in part for c in ODD_SPACE)
            ids += [cache.get(c) or self.chunk(c) for c in (filter(None, self.space.split(part)) if odd else part.split())]
        return " ".join(ids)

    def decode(self, ids: str) -> str:
        """`decoded` ids of a text."""
        return decoded(self.label, ids)


def labels_of(files: dict) -> dict[str, str]:
    """Id, in decimal: its label."""
    return {str(i): s for s, i in (files["vocab"] | files["special"]).items()}


def decoded(labels: dict[str, str], ids: str) -> str:
    """The labels of ids (joined by one space), joined by one space; an id
    that the vocabulary does not hold emits nothing."""
    return " ".join([labels[i] for i in ids.split(" ") if i in labels])


_encoders: dict[str, Encoder] = {}


def encoder_of(shipped: tuple) -> Encoder:
    """The worker's encoder of a shipped vocabulary; tasks of one worker share it."""
    name, files = shipped
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(parse_vocabulary(files.value))
    return _encoders[name]


def _broadcast(df: DataFrame, path: str) -> tuple:
    """The tokenizer file by the hash of its text: workers parse it, and keep the encoder alone."""
    with open(path, encoding="utf-8") as f:
        file = f.read()
    return hashlib.sha256(file.encode()).hexdigest(), df.sparkSession.sparkContext.broadcast(file)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to keep, n_tokens, ids array<int>: one row per input row.

    A null text is empty and has no tokens; null ids stay null; repeated rows
    are encoded each; other columns are not looked at.  ``path`` is the
    tokenizer file on the driver, shipped to the workers (2 MB).
    """
    files = _broadcast(docs, path)

    def run(b: pa.RecordBatch) -> dict:
        e = encoder_of(files)
        ids = [np.fromstring(e.encode(t), dtype=np.int32, sep=" ") for t in b.column(0).to_pylist()]
        n = np.array([len(i) for i in ids])
        lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(n))).astype(np.int32), np.concatenate(ids))
        return dict(zip((id_col, *keep), b.columns[1:])) | {"n_tokens": n, "ids": lists}

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (id_col, *keep))
    return map_batches(docs.select(text_of(text_col).alias("__text"), id_col, *keep), run, f"{kinds}, n_tokens bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded with text: the labels of its ids, joined by one space.

    Null or no ids give an empty text, ids that the vocabulary does not hold
    (null ones too) emit nothing; repeated rows are decoded each, an empty
    table gives no rows; all columns stay, but for one named text.  Workers
    get the labels alone: no automaton, no table of words.
    """
    labels = encoded.sparkSession.sparkContext.broadcast(labels_of(read_vocabulary(path)))
    kept = encoded.drop("text")

    def run(b: pa.RecordBatch) -> dict:
        ids = b.column(b.schema.names.index("ids"))
        texts = [decoded(labels.value, " ".join(map(str, i.as_py() or ()))) for i in ids]
        return dict(zip(b.schema.names, b.columns)) | {"text": texts}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return map_batches(kept, run, f"{schema}, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 without moving the ids: each
    text is encoded, and its ids are decoded again.  Cases as in `encode`."""
    files = _broadcast(docs, path)

    def sha(s: str) -> str:
        return hashlib.sha256(s.encode()).hexdigest()

    def run(b: pa.RecordBatch) -> dict:
        e = encoder_of(files)
        out: dict = {id_col: b.column(0), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for t in b.column(1).to_pylist():
            ids = e.encode(t)
            out["n_tokens"].append(ids.count(" ") + 1 if ids else 0)
            out["ids_sha256"].append(sha(ids))
            out["decoded_sha256"].append(sha(e.decode(ids)))
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_of(text_col).alias("text")), run,
                       f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")

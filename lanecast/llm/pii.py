"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in the whole text: at-signs, URL
schemes, account cues, plus signs and digits.  From each anchor a local,
deterministic parser expands to the left and right, and validates what it
found.  Parsers of one kind never look behind the end of their last match, so
the spans are those of a leftmost non-overlapping scan.

Kinds: email, ip, card, phone (all four as defined by their grammar); the
expansion adds ``address`` (a URL that carries a user's credentials) and
``account`` (an international bank account number whose check digits hold,
with or without its cue word, printed in groups or not).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from lanecast.llm.common import map_batches, text_of

# Kinds in the order that breaks ties of start.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")

# Anchors of the automaton.
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "sftp://", "redis://", "postgres://", "mysql://", "mongodb://")
CUES = ("IBAN", "iban", "Iban", "account", "Account", "ACCOUNT", "acct", "Acct", "konto", "Konto", "compte", "Compte",
        "cuenta", "Cuenta")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+:[A-Za-z0-9._~%!$&'()*+,;=-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_AFTER_CUE = re.compile(r"(?i:[ ]?(?:number|no\.?|nr\.?|n°)?)[ ]?[:#=]?[ ]?")

_automata: list[ahocorasick.Automaton] = []


def anchors() -> ahocorasick.Automaton:
    """The automaton; its values are (kind of anchor, length)."""
    if not _automata:
        a = ahocorasick.Automaton()
        for words, kind in ((("@",), "at"), (("+",), "plus"), ("0123456789", "digit"), (SCHEMES, "scheme"), (CUES, "cue")):
            for w in words:
                a.add_word(w, (kind, len(w)))
        a.make_automaton()
        _automata.append(a)
    return _automata[0]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_end(text: str, start: int) -> int | None:
    """End of an account number at start whose check digits hold, longest first."""
    m = _IBAN.match(text, start)
    if not m:
        return None
    # the match may run on into the next words: it may also end before any of its spaces
    for end in (m.end(), *(i for i in range(m.end() - 1, start, -1) if text[i] == " ")):
        s = text[start:end].replace(" ", "")
        if len(s) < 15:
            return None
        if int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1:
            return end
    return None


def find(text: str) -> list[tuple[str, int, int]]:
    """All validated spans as (kind, start, end), by start and kind."""
    out: list[tuple[str, int, int]] = []
    # where the last match of a kind ended, failed ones included
    email = ip = card = phone = url = account = 0
    n = len(text)
    for last, (kind, size) in anchors().iter(text):
        at = last - size + 1
        if kind == "digit":
            if at >= card:
                m = _DIGITS.match(text, at)
                if m:
                    card = m.end()
                    if card - at >= 14:
                        d = m[0].replace(" ", "").replace("-", "")
                        if 14 <= len(d) <= 19 and luhn(d):
                            out.append(("card", at, card))
                else:
                    card = at + 1
            if at >= ip:
                m = _DOTTED.match(text, at)
                if m:
                    ip = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                        out.append(("ip", at, ip))
                else:  # a later start in the same run of digits fails alike
                    ip = at + 1
                    while ip < n and "0" <= text[ip] <= "9":
                        ip += 1
            if at >= 2 and at >= account and "A" <= text[at - 1] <= "Z" and "A" <= text[at - 2] <= "Z" and not (
                    at > 2 and text[at - 3].isalnum()):
                end = iban_end(text, at - 2)
                if end:
                    out.append(("account", at - 2, end))
                    account = end
        elif kind == "plus":
            if at >= phone:
                m = _PHONE.match(text, at)
                if m:
                    phone = m.end()
                    if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                        out.append(("phone", at, phone))
        elif kind == "at":
            start = at
            while start > email and _LOCAL.match(text, start - 1):
                start -= 1
            m = _DOMAIN.match(text, at + 1) if start < at else None
            if m:
                email = m.end()
                out.append(("email", start, email))
        elif kind == "scheme":
            if at >= url:
                m = _USERINFO.match(text, last + 1)
                if m:
                    url = m.end()
                    out.append(("address", at, url))
        else:
            start = _AFTER_CUE.match(text, last + 1).end()
            if start >= account and (end := iban_end(text, start)):
                out.append(("account", start, end))
                account = end
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every text: the id, n_<kind> of the four base kinds, spans
    (kind:start:end, comma-joined, code points, end exclusive), base_sha256.

    One row per input row, repeated rows included; null and empty texts have
    no spans; a null id stays null; other columns are not looked at.
    """
    def run(b: pa.RecordBatch) -> dict:
        found = [find(t) for t in b.column(1).to_pylist()]
        base = [[s for s in f if s[0] in BASE] for f in found]
        return {id_col: b.column(0),
                **{f"n_{k}": [sum(s[0] == k for s in f) for f in base] for k in BASE},
                "base_sha256": [hashlib.sha256(joined(f).encode()).hexdigest() for f in base],
                "spans": [joined(f) for f in found]}

    kind = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in BASE)
    return map_batches(docs.select(id_col, text_of(text_col).alias("text")), run,
                       f"`{id_col}` {kind}, {counts}, base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[str, int, int]]) -> Iterator[str]:
    """Pieces of the text with each span replaced by its kind in brackets."""
    done = 0
    for kind, a, b in spans:
        if b <= done:
            continue
        yield text[done:max(a, done)]
        yield f"[{kind.upper()}]"
        done = b
    yield text[done:]

"""Fill-in-the-middle transformation of whole texts by repeated-capture matching.

One full match of ``(unit)*`` over a text keeps the end of every repetition of
its group: their number is the number of units and the ends are the offsets a
text can be cut at.  Two hashes of the document's id pick the cuts, two more
the form (plain, prefix-suffix-middle or suffix-prefix-middle), so a rerun, a
lost executor or another partitioning gives the same rows.

The match keeps about 140 bytes a unit.  A text of more than `Fim.run` code
points is therefore matched in runs of that many units, each beginning where
the last one ended; what is kept of a run is its ends, four bytes each.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecast.llm.common import map_batches, text_of

# The sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINEL = regex.compile("<[PSM]>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
FORM = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


@dataclass(frozen=True)
class Fim:
    """unit: pattern of one unit (any code point); a text that units do not
    tile whole stays plain with n null.  seed: of the hashes.  apply_percent of
    the texts are cut, spm_percent of those with the suffix first.  run: units
    of one match."""

    unit: str = r"(?s:.)"
    seed: int = 1
    apply_percent: int = 90
    spm_percent: int = 20
    run: int = 1 << 18


class Cutter:
    """Units of a text and the two cuts among them."""

    def __init__(self, fim: Fim):
        self.fim = fim
        self.whole = regex.compile(f"({fim.unit})*")
        self.part = regex.compile(f"({fim.unit}){{1,{fim.run}}}")

    def ends(self, text: str) -> np.ndarray | None:
        """The end of every unit; None if units do not tile the text."""
        if len(text) <= self.fim.run:
            m = self.whole.fullmatch(text)
            return None if m is None else np.array(m.ends(1), dtype=np.int64)
        runs, at = [], 0
        while at < len(text):
            m = self.part.match(text, at)
            if m is None or m.end() == at:
                return None
            runs.append(np.array(m.ends(1), dtype=np.uint32))
            at = m.end()
        return np.concatenate(runs)

    def cut(self, key, text: str) -> tuple[int | None, str, int | None, int | None, str]:
        """n, form, prefix_chars, middle_chars and output of one text."""
        h = draws(self.fim.seed, key)
        ends = self.ends(text)
        n = None if ends is None else len(ends)
        if not n or h[2] % 100 >= self.fim.apply_percent or SENTINEL.search(text):
            return n, PLAIN, None, None, text
        first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        a, b = (int(ends[k - 1]) if k else 0 for k in (first, last))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h[3] % 100 < self.fim.spm_percent:
            return n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def draws(seed: int, key) -> tuple[int, ...]:
    """Four unsigned numbers of 32 bits from the decimal key (a null key: nothing)."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4))


def transform(docs: DataFrame, fim: Fim = Fim(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, n (units), form, prefix_chars, middle_chars, output.

    One row per input row, repeated rows included (equal ids and texts give
    equal rows).  A null text is empty; an empty text, one that holds a
    sentinel and one that units do not tile are plain, their output the text
    itself; both cuts may fall together (an empty middle) or on an end of the
    text.  A null id draws from the hash of no digits.  An empty table gives
    no rows; other columns are not looked at.
    """
    def run(b: pa.RecordBatch) -> dict:
        cutter = Cutter(fim)
        rows = [cutter.cut(k, t) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        return dict(zip((id_col, "n", "form", "prefix_chars", "middle_chars", "output"),
                        (b.column(0), *map(list, zip(*rows)))))

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_of(text_col).alias("text")), run, f"`{id_col}` {kind}, {FORM}")


def restored(form: str = "form", output: str = "output") -> Column:
    """The text, rebuilt from its output and form.  A text that was cut holds no
    sentinel and none can arise across a seam, as sentinels begin and end with
    characters they hold nowhere else: an output splits at its own three."""
    at = F.split(F.col(output), "<[PSM]>", -1)
    part = lambda i: F.get(at, F.lit(i))
    return (F.when(F.col(form) == PSM, F.concat(part(1), part(3), part(2)))
            .when(F.col(form) == SPM, F.concat(part(2), part(3), part(1))).otherwise(F.col(output)))


def restore(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of `transform` with their texts rebuilt instead of the output."""
    return rows.withColumn(text_col, restored()).drop("output")


def digests(docs: DataFrame, fim: Fim = Fim(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`transform` with digests of the output and of the text rebuilt from it."""
    rows = transform(docs, fim, id_col, text_col)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select(id_col, "n", "form", "prefix_chars", "middle_chars",
                       sha(F.col("output")).alias("output_sha256"), sha(restored()).alias("restored_sha256"))

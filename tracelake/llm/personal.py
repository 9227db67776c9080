"""Personal data in texts: four fixed patterns, and what a word-shape CRF finds beside them.

Spans count code points, end exclusive. The patterns' spans always stand; a span of the model
is added where it touches none of them. The model is trained on the driver from the small
labelled table (a few hundred short lines, independent of the input) and sent with the task.

Defined results: a null or empty text has no spans; repeated rows give repeated results; an
empty table gives no rows; :func:`find` reads two columns, :func:`mask` keeps all columns.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.blocks import SPACE, Texts, blocks, byte_set
from tracelake.llm.crf import KINDS, LABELS, Crf, core, luhn, shape, train

# The patterns. A match of IP starts at the first digit of a run or not at all, so what stands
# before it is tested first: long runs of digits are then read once.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARKS = byte_set(b"0123456789@")
_NOT_DIGIT = re.compile("[^0-9]")
_LONG_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9]){13}")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of EMAIL, found from each ``@`` outwards, so that long plain words cost nothing."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        a = at
        while a > free and text[a - 1] in _LOCAL:
            a -= 1
        m = EMAIL.match(text, a) if a < at else None
        if m:
            out.append(m.span())
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _byte(digits: str) -> bool:
    """Whether ASCII digits, of any number, are at most 255."""
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the patterns, by start and then kind."""
    out = [(a, b, 0) for a, b in _emails(text)]
    for m in IP.finditer(text) if "." in text else ():
        if all(_byte(p) for p in m[0].split(".")):
            out.append((*m.span(), 1))
    for m in CARD.finditer(text) if _LONG_DIGITS.search(text) else ():
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), 2))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((*m.span(), 3))
    return sorted((a, b, k) for a, b, k in out) if len({a for a, _, _ in out}) == len(out) else sorted(out, key=lambda s: (s[0], s[2]))


def plausible(surface: str, kind: str) -> bool:
    """What a span of the model must hold besides, so that numbers of other kinds stay alone."""
    digits = _NOT_DIGIT.sub("", surface)
    if kind == "email":
        name, _, host = surface.partition("@")
        return bool(name) and "." in host.strip(".") and "@" not in host
    if kind == "ip":
        parts = [p for p in surface.partition(":")[0].split(".") if p]
        return len(parts) == 4 and all(p.isascii() and p.isdecimal() and _byte(p) for p in parts)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def model_spans(model: Crf, texts: list[str], runs: list[list[list[tuple[int, int]]]]) -> list[list[tuple[int, int, int]]]:
    """Spans that the CRF finds in the runs (lists of word places) of each text."""
    flat = [(i, run) for i, some in enumerate(runs) for run in some]
    paths = model.decode([[shape(texts[i][a:b]) for a, b in run] for i, run in flat])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (i, run), path in zip(flat, paths):
        t = 0
        while t < len(run):
            label = LABELS[path[t]]
            if label == "O":
                t += 1
                continue
            last = t
            while last + 1 < len(run) and LABELS[path[last + 1]] == f"I-{label[2:]}":
                last += 1
            text = texts[i]
            a = run[t][0] + core(text[slice(*run[t])])[0]
            b = run[last][0] + core(text[slice(*run[last])])[1]
            if a < b and plausible(text[a:b], label[2:]):
                out[i].append((a, b, KINDS.index(label[2:])))
            t = last + 1
    return out


def find_spans(model: Crf, texts: Texts) -> list[list[tuple[int, int, int, bool]]]:
    """All spans of each row as (start, end, kind number, from a pattern)."""
    n = len(texts)
    words = texts.runs(~SPACE[texts.data])
    marks = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(_MARKS[texts.data], out=marks[1:])
    telling = np.flatnonzero(marks[words.end] > marks[words.start])
    out: list[list[tuple[int, int, int, bool]]] = [[] for _ in range(n)]
    if not len(telling):
        return out
    chars = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum((texts.data & 0xC0) != 0x80, out=chars[1:])
    row = np.searchsorted(words.first, telling, "right") - 1
    zero = chars[texts.offsets[row]]
    a, b = chars[words.start[telling]] - zero, chars[words.end[telling]] - zero
    joined = np.append(False, (np.diff(telling) == 1) & (np.diff(row) == 0))
    rows = np.unique(row).tolist()
    body = texts.data.tobytes()
    text = [body[texts.offsets[r]:texts.offsets[r + 1]].decode("utf-8", "replace") for r in rows]
    runs: list[list[list[tuple[int, int]]]] = [[] for _ in rows]
    where = {r: i for i, r in enumerate(rows)}
    for r, x, y, more in zip(row.tolist(), a.tolist(), b.tolist(), joined.tolist()):
        if more:
            runs[where[r]][-1].append((x, y))
        else:
            runs[where[r]].append([(x, y)])
    for r, t, added in zip(rows, text, model_spans(model, text, runs)):
        base = base_spans(t)
        taken, starts, reach = [*base], sorted(s[0] for s in base), list(accumulate((s[1] for s in sorted(base)), max))
        end = 0
        for s in sorted(added):
            before = bisect_left(starts, s[1])
            if s[0] >= end and (not before or reach[before - 1] <= s[0]):
                taken.append(s)
                end = s[1]
        out[r] = sorted(((x, y, k, i < len(base)) for i, (x, y, k) in enumerate(taken)), key=lambda s: (s[0], s[2]))
    return out


@lru_cache(maxsize=1)
def default_model() -> Crf:
    return train()


def _listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k, _ in spans)


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("by_pattern", pa.bool_())]))


def find(docs: DataFrame, model: Crf | None = None) -> DataFrame:
    """``doc_id``, the patterns' counts and digest, all spans as text, and as ``found`` (array of structs)."""
    model = model or default_model()
    schema = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
              "found array<struct<kind:string,start:long,end:long,by_pattern:boolean>>")

    def run(batches):
        for batch in batches:
            for rows, texts in blocks(batch):
                spans = find_spans(model, texts)
                base = [[s for s in row if s[3]] for row in spans]
                cols = [rows.column(0)]
                cols += [pa.array([sum(s[2] == k for s in row) for row in base], pa.int64()) for k in range(len(KINDS))]
                cols += [pa.array([hashlib.sha256(_listed(row).encode()).hexdigest() for row in base], pa.string()),
                         pa.array([_listed(row) for row in spans], pa.string()),
                         pa.array([[{"kind": KINDS[k], "start": a, "end": b, "by_pattern": p} for a, b, k, p in row] for row in spans], SPANS)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "found"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def mask(docs: DataFrame, text: str = "text", model: Crf | None = None) -> DataFrame:
    """The same rows and columns with every span replaced by its kind in brackets; null stays null."""
    model = model or default_model()
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for rows, texts in blocks(batch, text):
                own = rows.column(at)
                values = own.to_pylist()
                for i, spans in enumerate(find_spans(model, texts)):
                    if spans:
                        out, free, t = [], 0, texts.data[texts.offsets[i]:texts.offsets[i + 1]].tobytes().decode("utf-8", "replace")
                        for a, b, k, _ in spans:
                            if b > free:
                                out += [t[free:a], f"[{KINDS[k].upper()}]"] if a >= free else []
                                free = b
                        values[i] = "".join([*out, t[free:]])
                cols = [pa.array(values, own.type) if j == at else rows.column(j) for j in range(rows.num_columns)]
                yield pa.RecordBatch.from_arrays(cols, rows.schema.names)

    return docs.mapInArrow(run, docs.schema)

"""Line-first quality rules.

Each line of a document is judged by itself: punctuation (a short line without any sentence
mark), navigation (menu separators, arrows, short link lists), boilerplate (fixed phrases),
symbols and repetition (equal to an earlier line). Failing lines are removed, and a document
that loses more than a given share of its words is rejected.

Defined results: a null or empty text has no words and is rejected; columns of the input are
kept, a column of the input with the name of an output is replaced; repeated rows are judged
alike, each by itself. No row is dropped by :func:`clean`; the caller filters on ``kept``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm.blocks import LOWER, SPACE, Hashes, Spans, Texts, blocks, byte_set, grams_of, sums_by

SYMBOLS = byte_set(b"#*$%&|<>")
SENTENCE_MARKS = byte_set(b".!?:;,\"')]}")
#: Last three bytes of wider closing marks: ... 。 ！ ？ and closing quotes.
WIDE_MARKS = tuple(m.encode()[-3:] for m in ("…", "。", "！", "？", "”", "’"))
#: Phrases that stand in page furniture.
BOILERPLATE = (
    b"all rights reserved", b"cookie policy", b"accept cookies", b"privacy policy", b"terms of use",
    b"terms of service", b"enable javascript", b"subscribe to our", b"sign up for our", b"click here",
    b"lorem ipsum", b"share this", b"read more", b"log in", b"skip to content")
MENU_MARKS = (b" | ", b" > ", b" \xc2\xbb ", b" \xc2\xb7 ", b" \xe2\x80\xba ", b"\xe2\x86\x92")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bad_lines", "n_lost_words")


@dataclass(frozen=True)
class Rules:
    short_line: int = 5          # words up to which a line without sentence mark fails
    menu_words: int = 12         # words up to which a line with two menu marks is navigation
    boiler_words: int = 30       # words up to which a fixed phrase condemns its line
    symbols_per_word: float = 0.5
    max_lost: float = 0.5        # share of words that a document may lose
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8


def _places(body: bytes, needle: bytes) -> list[int]:
    out, at = [], body.find(needle)
    while at >= 0:
        out.append(at)
        at = body.find(needle, at + 1)
    return out


def _line_hits(body: bytes, needles, lines: Spans) -> np.ndarray:
    """Phrases in each line; one that only stands across the end of a line, or of a text, is none."""
    hits = np.zeros(len(lines), np.int64)
    for needle in needles:
        at = np.array(_places(body, needle), np.int64)
        if len(at):
            line = np.searchsorted(lines.start, at, "right") - 1
            np.add.at(hits, line[at + len(needle) <= lines.end[line]], 1)
    return hits


def _repeats_earlier(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """True where the same key stood earlier in the same row."""
    order = np.lexsort((np.arange(len(keys)), keys, row))
    same = np.zeros(len(keys), bool)
    same[1:] = (keys[order][1:] == keys[order][:-1]) & (row[order][1:] == row[order][:-1])
    out = np.zeros(len(keys), bool)
    out[order] = same
    return out


def judge(texts: Texts, rules: Rules) -> tuple[dict[str, np.ndarray], Texts]:
    """Counts and verdict per row, and the texts without failing lines."""
    data = texts.data
    words = texts.runs(~SPACE[data])
    hashes = Hashes(data)
    n_words = words.per_row
    lines = texts.lines()
    in_line = np.searchsorted(words.start, lines.start), np.searchsorted(words.start, lines.end)
    line_words = in_line[1] - in_line[0]
    full = line_words > 0

    # a continuation byte of UTF-8 starts no code point
    char = ~SPACE[data] & ((data & 0xC0) != 0x80)
    symbol = SYMBOLS[data]

    again = np.zeros(len(lines), bool)
    if full.any():
        again[full] = _repeats_earlier(hashes.of(lines.start[full], lines.end[full]), lines.row[full])

    gram, place, begins = grams_of(hashes.of(words.start, words.end), words.first, rules.window)
    row = np.repeat(np.arange(len(texts)), np.diff(begins))
    order = np.lexsort((gram, row))
    g, r = gram[order], row[order]
    twin = np.zeros(len(order), bool)
    if len(order) > 1:
        pair = (g[1:] == g[:-1]) & (r[1:] == r[:-1])
        twin[1:] |= pair
        twin[:-1] |= pair
    cover = np.zeros(len(words) + 1, np.int64)
    at = place[order][twin]
    np.add.at(cover, at, 1)
    np.add.at(cover, at + rules.window, -1)
    repeated = np.cumsum(cover)[:-1] > 0

    # line rules
    last = np.zeros(len(lines), np.int64)
    last[full] = words.end[in_line[1][full] - 1]
    closed = np.zeros(len(lines), bool)
    closed[full] = SENTENCE_MARKS[data[last[full] - 1]]
    wide = full & (last >= 3)
    for m in WIDE_MARKS:
        closed[wide] |= ((data[last[wide] - 3] == m[0]) & (data[last[wide] - 2] == m[1]) & (data[last[wide] - 1] == m[2]))
    body = LOWER[data].tobytes()
    boiler = _line_hits(body, BOILERPLATE, lines) > 0
    menu = _line_hits(body, MENU_MARKS, lines) > 1
    signs = np.zeros(len(data) + 1, np.int64)
    np.cumsum(symbol, out=signs[1:])
    line_signs = signs[lines.end] - signs[lines.start]
    bad = full & (
        (~closed & (line_words <= rules.short_line))
        | (menu & (line_words <= rules.menu_words))
        | (boiler & (line_words <= rules.boiler_words))
        | (line_signs > rules.symbols_per_word * line_words)
        | again)
    lost = sums_by(np.where(bad, line_words, 0), lines.first)

    n_repeat = sums_by(repeated, words.first)
    failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeat_percent * n_words)
    out = {
        "n_words": n_words, "word_chars": sums_by(char, texts.offsets), "n_symbols": sums_by(symbol, texts.offsets),
        "n_dup_lines": sums_by(again, lines.first), "n_repeat_words": n_repeat, "n_lines": sums_by(full, lines.first),
        "n_bad_lines": sums_by(bad, lines.first), "n_lost_words": lost,
        "base_failed": failed, "kept": ~failed & (lost <= rules.max_lost * n_words)}

    # a removed line takes its line break along
    drop = np.zeros(len(data) + 1, np.int64)
    np.add.at(drop, lines.start[bad], 1)
    np.add.at(drop, np.minimum(lines.end[bad] + 1, texts.offsets[1:][lines.row[bad]]), -1)
    return out, texts.keep(np.cumsum(drop)[:-1] == 0)


def clean(docs: DataFrame, text: str = "text", rules: Rules = Rules(), cleaned: str | None = "clean_text") -> DataFrame:
    """Add the counts, ``base_failed``, ``kept`` and, if named, the cleaned text to every row."""
    added = [T.StructField(c, T.LongType()) for c in COUNTS]
    added += [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]
    added += [T.StructField(cleaned, T.StringType())] if cleaned else []
    names = {f.name for f in added}
    before = [f for f in docs.schema.fields if f.name not in names]

    def run(batches):
        for whole in batches:
            for part, texts in blocks(whole, text):
                got, rest = judge(texts, rules)
                cols = [part.column(part.schema.get_field_index(f.name)) for f in before]
                cols += [pa.array(got[c]) for c in (*COUNTS, "base_failed", "kept")]
                cols += [rest.column().cast(pa.string())] if cleaned else []
                yield pa.RecordBatch.from_arrays(cols, [*(f.name for f in before), *(f.name for f in added)])

    need = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*(f.name for f in before), text])])
    return need.mapInArrow(run, T.StructType([*before, *added]))

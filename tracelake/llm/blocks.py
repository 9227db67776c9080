"""Vector work on the texts of one Arrow batch: bytes, words, lines and polynomial hashes.

Every operator of this package that reads texts does so in ``mapInArrow``: a batch is cut into
blocks of a few megabytes (``BLOCK_BYTES``), so memory depends on the block and on the longest
single text, not on the partition. A null text counts as empty everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection), so that near inputs give unrelated outputs."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_set(chars: bytes | str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode("latin-1") if isinstance(chars, str) else chars)] = True
    return table


SPACE = byte_set(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS.get(kind)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 64)
        step = np.full(size, BASE if kind == "up" else _INVERSE, np.uint64)
        step[0] = 1
        have = np.cumprod(step)
        if size <= 4 * BLOCK_BYTES:
            _POWERS[kind] = have
    return have


class Hashes:
    """Prefix polynomial hashes of a byte array: the hash of any stretch in constant time."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * _powers("up", n)[:n], out=self.sums[1:])
        self.inverse = _powers("down", n + 1)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Hash of the ``k`` bytes from every place on."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.inverse[:n])


class Texts:
    """Texts of some rows as one byte array with row offsets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @classmethod
    def of(cls, column: pa.Array) -> "Texts":
        column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
        if column.null_count:
            column = column.fill_null(b"")
        _, offs, data = column.buffers()
        offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1] if offs else np.zeros(1, np.int64)
        body = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
        return cls(body, offsets - offsets[0])

    def column(self, string: bool = True) -> pa.Array:
        kind = pa.large_string() if string else pa.large_binary()
        return pa.Array.from_buffers(kind, len(self), [
            None, pa.py_buffer(np.ascontiguousarray(self.offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(self.data))])

    def keep(self, mask: np.ndarray) -> "Texts":
        """Only the bytes under the mask."""
        before = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=before[1:])
        return Texts(self.data[mask], before[self.offsets])

    def runs(self, inside: np.ndarray) -> "Spans":
        """Maximal runs of places under the mask; no run crosses a row's border."""
        n = len(inside)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edge = self.offsets[1:-1]
        before[edge[edge < n]] = False
        after[edge[edge > 0] - 1] = False
        start = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        return Spans(start, end, np.searchsorted(start, self.offsets))

    def lines(self) -> "Spans":
        """Stretches between ``\\n``; a row without text has one empty line."""
        cut = np.flatnonzero(self.data == 10)
        start = np.sort(np.concatenate([self.offsets[:-1], cut + 1]), kind="stable")
        # each row adds one line, and each \n one more
        row_first = np.arange(len(self) + 1) + np.searchsorted(cut, self.offsets)
        end = np.sort(np.concatenate([self.offsets[1:], cut]), kind="stable")
        return Spans(start, end, row_first)


class Spans:
    """Stretches of a byte array, in order, with the first one of every row."""

    def __init__(self, start: np.ndarray, end: np.ndarray, first: np.ndarray):
        self.start, self.end, self.first = start, end, first

    def __len__(self) -> int:
        return len(self.start)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    @property
    def per_row(self) -> np.ndarray:
        return np.diff(self.first)


def sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each stretch ``first[i]:first[i + 1]``, empty ones included."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def grams_of(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``n`` neighbours that lie in one row, their first places, and the rows' firsts."""
    count = np.diff(first)
    size = np.maximum(count - n + 1, 0)
    begins = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=begins[1:])
    place = np.arange(begins[-1]) + np.repeat(first[:-1] - begins[:-1], size)
    out = np.zeros(len(place), np.uint64)
    for i in range(n):
        out = out * BASE + hashes[place + i]
    return mix(out), place, begins


def blocks(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut a batch into blocks of whole rows with at most ``limit`` bytes of text (one row may have more)."""
    whole = Texts.of(batch.column(batch.schema.get_field_index(text)))
    lo = 0
    while lo < len(whole):
        hi = int(np.searchsorted(whole.offsets, whole.offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(whole))
        offs = whole.offsets[lo:hi + 1]
        yield batch.slice(lo, hi - lo), Texts(whole.data[offs[0]:offs[-1]], offs - offs[0])
        lo = hi

"""Token ids of whole texts by a public word-BPE tokenizer, each distinct word piece encoded once.

The tokenizer never looks across white space, and inside a word not across a change between
letters, digits and signs. So a text's ids are those of its pieces one after another. Pieces
of ASCII and Latin-1 letters, single digits and runs of ASCII signs are merged here, all new
ones of a block together, by the tokenizer's own vocabulary and merge ranks. Words with an
apostrophe, ``<`` or any other character stay whole and go through the library, since
contractions, special tokens, normal forms and Unicode classes live there; so do very long pieces.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pandas as pd

from tracelake.llm.blocks import LOWER, SPACE, Hashes, Texts, byte_set

#: Pieces a worker remembers; it starts anew when there are more. Only speed depends on it.
REMEMBER = 500_000
#: Bytes up to which a piece is merged here. Every round makes one merge per piece, so longer ones go through the library.
LONG = 64
GLUE, WHOLE = 4, 5
_KIND = np.full(256, 3, np.uint8)
_KIND[SPACE] = 0
_KIND[byte_set(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_KIND[byte_set(b"0123456789")] = 2
_KIND[byte_set(b"'<")] = GLUE
_KIND[128:] = GLUE
#: Second bytes of Latin-1 letters (the first is C3), and of the capitals among them.
_LATIN = (np.arange(256) >= 0x80) & (np.arange(256) <= 0xBF) & ~byte_set(b"\x97\xb7")
_LATIN_UPPER = _LATIN & (np.arange(256) <= 0x9E)
NO_MERGE = np.int64(1 << 30)


def tokenizer_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Merges:
    """Vocabulary and merge ranks of a word BPE, applied to many words at once."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.keys = np.full(1 << 20, np.iinfo(np.uint64).max, np.uint64)
        self.ranks = np.full(1 << 20, NO_MERGE, np.int64)
        slot, rank = self._slot(key), np.arange(len(key))
        while len(key):
            free = self.keys[slot] == np.iinfo(np.uint64).max
            _, one = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[one]
            self.keys[slot[put]], self.ranks[slot[put]] = key[put], rank[put]
            rest = np.ones(len(key), bool)
            rest[put] = False
            key, rank, slot = key[rest], rank[rest], (slot[rest] + 1) & 0xFFFFF
        letters = {b: c for c, b in _byte_letters().items()}
        self.single = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + "</w>"] for b in range(256)], np.int32)

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.uint64) << np.uint64(16) | right.astype(np.uint64)
        slot = self._slot(key)
        have = self.keys[slot]
        out = np.where(have == key, self.ranks[slot], NO_MERGE)
        open_ = np.flatnonzero((have != key) & (have != np.iinfo(np.uint64).max))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & 0xFFFFF
            have = self.keys[slot[open_]]
            hit = have == key[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (have != np.iinfo(np.uint64).max)]
        return out

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of every word ``data[start:end]``, and all ids."""
        size = end - start
        first = np.cumsum(size) - size
        at = np.repeat(start - first, size) + np.arange(size.sum())
        symbol = self.single[data[at]]
        symbol[first + size - 1] = self.last[data[end - 1]]
        word = np.repeat(np.arange(len(size)), size)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            rank = np.full(len(symbol), NO_MERGE, np.int64)
            rank[:-1] = np.where(word[1:] == word[:-1], self.rank(symbol[:-1], symbol[1:]), NO_MERGE)
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank << 31 | np.arange(len(rank)), begin)
            place, least = best & 0x7FFFFFFF, best >> 31
            going = least < NO_MERGE
            rest = np.repeat(going, np.diff(np.append(begin, len(symbol))))
            done.append((word[~rest], symbol[~rest]))
            symbol[place[going]] = self.made[least[going]]
            rest[place[going] + 1] = False
            symbol, word = symbol[rest], word[rest]
        words = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        ids = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int32)
        order = np.argsort(words, kind="stable")
        return np.bincount(words, minlength=len(size)), ids[order].astype(np.uint32)


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PieceEncoder:
    """Ids of texts; keeps the ids of pieces seen before."""

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(path))
        self.merges = Merges(json.loads(self.tokenizer.to_str())["model"])
        self._forget()

    def _forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _pieces(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes in lower case, first and last place of each piece, kind of each byte."""
        data, n = texts.data, len(texts.data)
        kind, lowered = _KIND[data], LOWER[data]
        c3 = np.flatnonzero(data[:-1] == 0xC3) if n else np.zeros(0, np.int64)
        c3 = c3[_LATIN[data[c3 + 1]]]
        kind[c3] = kind[c3 + 1] = 1
        lowered[c3 + 1] += np.where(_LATIN_UPPER[data[c3 + 1]], 32, 0).astype(np.uint8)
        glue = np.flatnonzero(kind == GLUE)
        if len(glue):
            words = texts.runs(kind != 0)
            whole = np.unique(np.searchsorted(words.start, glue, "right") - 1)
            size = (words.end - words.start)[whole]
            at = np.repeat(words.start[whole] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            kind[at] = WHOLE
            angle = np.unique(np.searchsorted(words.start, np.flatnonzero(data == 60), "right") - 1)
            for s, e in zip(words.start[angle].tolist(), words.end[angle].tolist()):
                lowered[s:e] = data[s:e]  # a special token is told by its case
        cut = np.ones(n + 1, bool)
        cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        cut[texts.offsets] = True
        full = kind != 0
        return lowered, np.flatnonzero(cut[:-1] & full), np.flatnonzero(cut[1:] & full) + 1, kind

    def __call__(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows one after another, and the first place of every row."""
        lowered, start, end, kind = self._pieces(texts)
        code, unique = pd.factorize(Hashes(lowered).of(start, end))
        place = np.searchsorted(self.keys, unique)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == unique[known]
        if not known.all():
            if len(self.keys) > REMEMBER:
                self._forget()
                known[:] = False
            one = np.zeros(len(unique), np.int64)
            one[code] = np.arange(len(code))  # a place where each piece stands
            new = np.flatnonzero(~known)
            plain = (kind[start[one[new]]] != WHOLE) & ((end - start)[one[new]] <= LONG)
            new = np.concatenate([new[plain], new[~plain]])
            at = one[new]
            m = int(plain.sum())
            sizes, ids = self.merges(lowered, start[at[:m]], end[at[:m]])
            body = lowered.tobytes()
            rest = [body[a:b].decode("utf-8", "replace") for a, b in zip(start[at[m:]].tolist(), end[at[m:]].tolist())]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            self._learn(unique[new], np.concatenate([sizes, np.array([len(x) for x in found], np.int64)]),
                        np.concatenate([ids, np.array([i for x in found for i in x], np.uint32)]))
            place = np.searchsorted(self.keys, unique)
        begin = self.first[place][code] if len(code) else np.zeros(0, np.int64)
        size = self.first[place + 1][code] - begin if len(code) else begin
        begins = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=begins[1:])
        source = np.repeat(begin - begins[:-1], size)
        source += np.arange(len(source))
        return self.ids[source], begins[np.searchsorted(start, texts.offsets)]

    def _learn(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        all_keys = np.concatenate([self.keys, keys])
        all_sizes = np.concatenate([np.diff(self.first), sizes])
        starts = np.concatenate([self.first[:-1], len(self.ids) + np.cumsum(sizes) - sizes])
        pool = np.concatenate([self.ids, ids])
        order = np.argsort(all_keys, kind="stable")
        self.keys, size = all_keys[order], all_sizes[order]
        self.first = np.zeros(len(order) + 1, np.int64)
        np.cumsum(size, out=self.first[1:])
        self.ids = pool[np.repeat(starts[order] - self.first[:-1], size) + np.arange(self.first[-1])]


_ENCODERS: dict[str | None, PieceEncoder] = {}


def encoder(path: str | None = None) -> PieceEncoder:
    """One encoder per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]

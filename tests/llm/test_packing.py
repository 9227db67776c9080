import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tracelake.llm.packing import pack, plan_packing, sequences, slots
from tracelake.llm.tokens import PieceEncoder, tokenizer_path
from tracelake.llm.blocks import Texts

SCHEMA = "doc_id long, text string"
ODD = ["it's WON'T <|endoftext|> <|ENDOFTEXT|>x a<b É é \xa0x y 12ab34,.;", "ΑΣ ß ŒUVRE naïve x́ İstanbul K \x1c\x1d z",
       "x" * 300 + " 1234567890", "a\u0085b　c 'S '<|startoftext|>'", "Äpfel ÷×÷ ÀÉÿþ", "\x00\x01 tab\tend", "漢字 かな mixed漢a1", ""]


def test_ids_equal_the_library(spark):
    import pyarrow as pa

    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    own = PieceEncoder()
    for _ in range(2):  # cold and remembered
        ids, first = own(Texts.of(pa.array(texts)))
        for i, t in enumerate(texts):
            assert ids[first[i]:first[i + 1]].tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids, t[:80]


@pytest.mark.parametrize("seed,n", [(1, 30_000), (2, 200), (3, 5), (4, 0)])
def test_plan_uses_every_piece_once(seed, n):
    rng = np.random.default_rng(seed)
    counts = np.bincount(np.clip(rng.lognormal(6.2, 1.3, n).astype(int), 1, 4096), minlength=4097)
    plan = plan_packing(counts)
    used = np.zeros(4097, np.int64)
    for pattern, times in plan:
        assert times > 0 and sum(k * v for k, v in pattern.items()) <= 4096
        for k, v in pattern.items():
            used[k] += v * times
    assert (used == counts).all()
    least = -(-int((counts * np.arange(4097)).sum()) // 4096)
    assert sum(t for _, t in plan) <= least + max(1, least // 50)
    assert len(slots(plan, 4096)["lo"]) <= 90 * max(1, len(plan))


def test_exact_complements_are_found():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 70, 20, 10, 55, 15]] = [2, 2, 3, 3, 3, 1, 3]
    assert sum(t for _, t in plan_packing(counts)) == 6 and counts.sum() == 17


def test_pack_round_trip(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    docs += [(5000, None), (5001, ""), (5002, "many words here " * 4000), (None, "no id"), (5003, "same"), (5003, "same")]
    packed = pack(spark.createDataFrame(docs, SCHEMA).repartition(4), keep_ids=True).cache()
    rows = packed.collect()
    library = Tokenizer.from_file(tokenizer_path())
    by_doc = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, t in docs:
        want = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        if i != 5003:
            assert b"".join(r.ids for r in parts) == want
            assert [r.start for r in parts] == list(range(0, len(want) // 4, 4096))
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for some in places.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 4096
    whole = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    assert {k: len(v) // 4 for k, v in whole.items()} == {k: sum(n for _, n in v) for k, v in places.items()}
    assert pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_very_long_word_goes_through_the_library():
    import time

    import pyarrow as pa

    rng = np.random.default_rng(1)
    letters = "".join(map(chr, rng.integers(97, 123, 10 ** 6)))
    own = PieceEncoder()
    texts = [letters, "a" * 64 + " " + "ab" * 33, letters[:64], letters[:65] + "É" * 70, "acgt" * 5000]
    begin = time.process_time()
    ids, first = own(Texts.of(pa.array(texts)))
    assert time.process_time() - begin < 60
    for i, t in enumerate(texts):
        assert ids[first[i]:first[i + 1]].tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids

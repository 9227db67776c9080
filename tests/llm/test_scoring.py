import math
import zlib

import numpy as np
import zstandard

from tests.llm.brute import WORD, lower
from tracelake.llm import recurrent as R
from tracelake.llm import scoring as S
from tracelake.llm.scoring import score_documents

SCHEMA = "doc_id long, text string"


def brute(docs):
    words = {i: [*WORD.findall(lower(t)), None] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    count = {}
    for i, w in words.items():
        if not held[i]:
            for x in w:
                count[x] = count.get(x, 0) + 1
    n, v = sum(count.values()), len(count)
    return {i: (held[i], len(w), sum(x in count for x in w), n, sum(math.log10((count.get(x, 0) + 1) / (n + v + 1)) for x in w))
            for i, w in words.items()}


def test_counts_base_and_held_out(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    docs += [(70001, None), (70002, ""), (70003, "word " * 3000), (70004, "The THE the")]
    got = score_documents(spark.createDataFrame(docs, SCHEMA).repartition(3), batch_bytes=1 << 20).collect()
    want = brute(docs)
    assert len(got) == len(docs)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert abs(r.base_score - w[4]) < 1e-6 * max(1, abs(w[4]))
    unseen = [r for r in got if r.held_out]
    tokens = sum(r.n_tokens for r in unseen)
    assert sum(r.score for r in unseen) / tokens > sum(r.base_score for r in unseen) / tokens + 0.02


def test_untrained_model_is_the_base(spark):
    docs = [(i, f"a b c w{i % 40} x{i}") for i in range(300)] + [(900, "only once here")]
    got = score_documents(spark.createDataFrame(docs, SCHEMA), rounds=0).collect()
    weights_off = max(abs(r.score - r.base_score) / r.n_tokens for r in got)
    assert weights_off < 1e-4


def test_no_rows(spark):
    assert score_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_windows_and_lanes_do_not_matter():
    rng = np.random.default_rng(0)
    share = np.zeros(R.WORDS)
    share[:200] = rng.random(200)
    flat = R.start(share / share.sum()) + rng.normal(0, 0.05, R.SIZE).astype(np.float32)
    first = np.append(0, np.cumsum(rng.integers(1, 40, 30)))
    words = rng.integers(0, 200, first[-1])
    a = R.log_likelihoods(flat, words, first, 0, lanes=1, window=1000)
    b = R.log_likelihoods(flat, words, first, 0, lanes=7, window=5)
    assert np.allclose(a, b, atol=1e-3)
    w = R.parts(flat)
    total = np.exp(R.word_log_probs(w, np.tile(rng.normal(size=(1, R.HIDDEN)).astype(np.float32), (R.WORDS, 1)), np.arange(R.WORDS))).sum()
    assert abs(total - 1) < 1e-3


def test_gradients():
    rng = np.random.default_rng(1)
    share = np.full(R.WORDS, 1 / R.WORDS)
    flat = (R.start(share) + rng.normal(0, 0.1, R.SIZE)).astype(np.float32)
    word, prior = rng.integers(0, R.WORDS, (6, 3)), rng.integers(0, R.WORDS, (6, 3))
    new = np.zeros((6, 3), bool)
    new[3, 1] = True

    def loss(f):
        w = R.parts(f.astype(np.float64))
        h, total = np.zeros((3, R.HIDDEN)), 0.0
        for t in range(6):
            h = np.where(new[t][:, None], 0, h)
            h = R._step(h, w["embed"][prior[t]] @ w["wx"] + w["b"], w["wh"])[0]
            total -= R.word_log_probs(w, h, word[t]).sum()
        return total / word.size

    t = R.Trainer(flat, rate=0.0)
    t._window(word, prior, new, np.zeros((3, R.HIDDEN), np.float32))
    grad = t.one / 0.1
    start = {}
    at = 0
    for k, s in R.SHAPES.items():
        start[k] = at
        at += int(np.prod(s))
    ratios = []
    for k in ("embed", "wx", "wh", "b", "wc", "bc", "ww", "bw"):
        i = start[k] + int(np.abs(grad[start[k]:start[k] + int(np.prod(R.SHAPES[k]))]).argmax())
        f = flat.astype(np.float64)
        f[i] += 1e-4
        up = loss(f)
        f[i] -= 2e-4
        ratios.append((up - loss(f)) / 2e-4 / grad[i])
    # one ratio for all: 1, or what the gradient was clipped by
    assert np.ptp(ratios) < 0.02 * abs(ratios[0]) and ratios[0] > 0.98, ratios


def test_rounds_read_every_training_word_once():
    sizes = [140_001, 4, 1, 3]
    held = np.array([False, True, False, False])
    first = np.append(0, np.cumsum(sizes))
    words = np.arange(first[-1]) % 4000
    row = {"held": held.tobytes(), "first": first.astype(np.int64).tobytes(), "words": zstandard.compress(words.astype(np.uint16).tobytes())}
    parts = [S.stretch(row, k, 3) for k in range(3)]
    wanted = np.concatenate([words[first[r]:first[r + 1]] for r in np.flatnonzero(~held)])
    assert np.array_equal(np.sort(np.concatenate([p for p, _ in parts])), np.sort(wanted))
    assert sum(int(f.sum()) for _, f in parts) == (~held).sum()
    assert all(len(p) > 40_000 for p, _ in parts)


def plain_log_likelihood(flat, words):
    """One document, word by word, in double precision, by the textbook's formulas."""
    w = {k: v.astype(np.float64) for k, v in R.parts(flat).items()}
    sigma = lambda x: 1 / (1 + np.exp(-x))
    n, h, before, total = R.HIDDEN, np.zeros(R.HIDDEN), S.END, 0.0
    for word in words:
        a, b = w["embed"][before] @ w["wx"] + w["b"], h @ w["wh"]
        z, r = sigma(a[:n] + b[:n]), sigma(a[n:2 * n] + b[n:2 * n])
        c = np.tanh(a[2 * n:] + r * b[2 * n:])
        h = (1 - z) * c + z * h
        k = next(i for i in range(R.CLASSES) if R.START[i] <= word < R.START[i + 1])
        classes = h @ w["wc"] + w["bc"]
        inside = w["ww"][R.START[k]:R.START[k + 1]] @ h + w["bw"][R.START[k]:R.START[k + 1]]
        total += classes[k] - np.log(np.exp(classes).sum()) + inside[word - R.START[k]] - np.log(np.exp(inside).sum())
        before = word
    return total


def test_score_equals_a_plain_sequential_model():
    rng = np.random.default_rng(5)
    flat = (R.start(np.full(R.WORDS, 1 / R.WORDS)) + rng.normal(0, 0.3, R.SIZE)).astype(np.float32)
    sizes = [1, 130, 7, 64, 65, 2, 300]
    first = np.append(0, np.cumsum(sizes))
    words = np.minimum(rng.zipf(1.3, first[-1]), R.WORDS) - 1
    ln = R.log_likelihoods(flat, words, first, S.END, lanes=3)
    for a, b in zip(first, first[1:]):
        assert abs(ln[a:b].sum() - plain_log_likelihood(flat, words[a:b].tolist())) < 1e-3 * (b - a)


def test_null_ids_and_repeated_rows(spark):
    docs = [(i, f"some words for number {i % 7} and more of them") for i in range(60)] + [(None, "an unnamed text"), (None, None)] + [(5, "said again")] * 4
    got = score_documents(spark.createDataFrame(docs, SCHEMA).coalesce(1)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in docs)
    held = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in docs}
    assert all(r.held_out == held[r.doc_id] for r in got)
    tokens = sum(len(WORD.findall(t or "")) + 1 for i, t in docs if not held[i])
    assert {r.train_tokens for r in got} == {tokens}
    for i in (None, 5):
        mine = [r for r in got if r.doc_id == i and r.n_tokens == 3]
        assert len({(r.base_score, round(r.score, 4)) for r in mine}) <= 1
    assert [r.n_tokens for r in got if r.doc_id is None].count(1) == 1  # a null text is its end alone


def test_trainer_uses_every_word():
    rng = np.random.default_rng(2)
    for n in (1, 31, 33, 1000, 1055):
        assert R.Trainer(R.start(np.full(R.WORDS, 1 / R.WORDS))).fit(rng.integers(0, 99, n), np.zeros(n, bool), 0) == n


def test_the_end_of_a_long_document_is_learnt(spark):
    rng = np.random.default_rng(3)
    noise = " ".join(f"w{k}" for k in rng.integers(0, 50, 70_000))
    held, kept = (next(i for i in range(99) if (zlib.crc32(str(i).encode()) % 7 == 2) == want) for want in (True, False))
    docs = [(kept, noise + " ping pong" * 35_000), (held, "ping pong " * 200)]
    got = {r.doc_id: r for r in score_documents(spark.createDataFrame(docs, SCHEMA).coalesce(1)).collect()}[held]
    assert got.held_out and got.score > 0.7 * got.base_score

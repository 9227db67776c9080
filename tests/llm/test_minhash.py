import random

from tests.llm.brute import near_groups

from tracelake.llm.minhash import least_matches, near_duplicates

SCHEMA = "doc_id long, text string"


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def edited(rng, w, k):
    w = list(w)
    for _ in range(k):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return w


def family(rng, n, copies, edits):
    base = words(rng, n)
    return [" ".join(edited(rng, base, edits)) for _ in range(copies)]


def compare(spark, texts, k=4):
    docs = list(enumerate(texts))
    want = near_groups(docs, k)
    got = near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(5), shingle=k).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


def test_chains_and_thresholds(spark):
    rng = random.Random(1)
    texts = []
    for edits in (1, 2, 3, 4, 5):  # similarity from well above to below 0.8 between siblings
        texts += family(rng, 120, 40, edits)
    base = words(rng, 200)
    for step in range(30):  # a chain: neighbours are linked, ends are not
        texts.append(" ".join(base[step * 3:] + [f"c{step}_{j}" for j in range(3)]))
    texts += ["", None, "one two", "ONE two", "a b c d", "a b c d e"] + ["same text here now then"] * 5
    rng.shuffle(texts)
    compare(spark, texts)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    want = near_groups([(r.doc_id, r.text) for r in docs], 5)
    got = near_duplicates(spark.createDataFrame(docs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_no_rows_and_no_ids(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, None)]
    got = sorted(near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(3, 3, True), (7, 7, True), (7, 7, True), (None, None, True), (None, None, True)]


def test_small_blocks_give_the_same(spark, monkeypatch):
    from tracelake.llm import minhash

    monkeypatch.setattr(minhash, "SIGNATURE_BLOCK", 7)
    monkeypatch.setattr(minhash, "SET_BLOCK", 400)
    rng = random.Random(4)
    compare(spark, [t for edits in (2, 3, 4) for t in family(rng, 90, 30, edits)])


def test_bounds_grow():
    bounds = least_matches(0.8)
    assert bounds[0][1] < bounds[-1][1] < 0.8 * 128

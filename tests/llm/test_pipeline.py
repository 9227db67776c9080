import corpus_pipeline as P
from tests.llm.brute import line_verdict, near_groups, poisson_copies
from tracelake.llm.tokens import PieceEncoder


def test_stages_against_plain_versions(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(None, "no id " * 30 + ".", "en", None, 1), (800_000, None, None, "src1", None), (800_001, "", "en", "src1", 0)],
                                  docs.schema)
    docs = docs.unionByName(extra)
    step = {}
    for name, stage in P.STAGES:
        docs = P.materialize(stage(spark, docs, sf), name)
        step[name] = docs.collect()
        if name != "packing":
            assert docs.columns == list(P.DOCUMENT)
    raw = [*spark.read.parquet(f"{sf}/documents.parquet").collect(), *extra.collect()]
    want = {(r.doc_id, line_verdict(r.text)[1]) for r in raw if line_verdict(r.text)[0]}
    assert {(r.doc_id, r.text) for r in step["quality"]} == want
    groups = near_groups([(r.doc_id, r.text) for r in step["quality"] if r.doc_id is not None], 5)
    left = {r.doc_id for r in step["near_duplicates"]} - {None}
    assert left == {i for i, (_, c) in groups.items() if i == c}
    assert [r.doc_id for r in step["personal_data"]].count(None) == [r.doc_id for r in step["quality"]].count(None)
    assert {r.doc_id for r in step["personal_data"]} - {None} == left
    assert all("@example.com" not in r.text for r in step["personal_data"])
    with_id = [r for r in step["mixing"] if r.doc_id is not None]
    if not any(r.doc_id is None for r in step["personal_data"]):
        copies = poisson_copies([(r.doc_id, r.source) for r in step["personal_data"]])
        assert {i: n for i, n in copies.items() if n} == {i: sum(r.doc_id == i for r in with_id) for i in {r.doc_id for r in with_id}}
    own = PieceEncoder()
    total = sum(len(own.tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in step["mixing"])
    assert sum(r.length for r in step["packing"]) == total


def test_repeated_rows_stay_once(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", "s", 1), (3, "other words than those above stand here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in P.near_duplicates(spark, docs, "").collect()) == [1, 3]


def test_run_on_no_rows(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_an_id_with_two_texts_loses_only_the_copy(spark):
    copy, own = " ".join(f"w{i}" for i in range(40)), " ".join(f"x{i}" for i in range(40))
    rows = [(1, copy, "en", "s", 1), (2, copy, "en", "s", 1), (2, own, "en", "s", 1), (3, own + " more", "en", "s", 1), (None, copy, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {(r.doc_id, r.text) for r in P.near_duplicates(spark, docs, "").collect()}
    assert left == {(1, copy), (2, own), (None, copy)}


def test_very_long_texts_and_clashing_columns(spark):
    long = " ".join(f"word{i % 5000}" for i in range(150_000)) + "."
    rows = [(1, long, "en", "s", 1, "a"), (2, long, "en", "s", 1, "b"), (3, "A short text that says enough to be kept, as it has many more words than the rules ask for, and ends well.", "en", None, 1, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _text string")
    for name, stage in P.STAGES:
        docs = P.materialize(stage(spark, docs, ""), name)
    assert {r.doc_id for r in docs.collect()} <= {1, 3}

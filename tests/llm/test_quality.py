from pyspark.sql import functions as F

from tests.llm.brute import line_verdict, quality_counts
from tracelake.llm.quality import clean

SCHEMA = "doc_id long, text string, kept string"
TEXT = "This is a line that says something useful to its readers.\n"
CASES = [
    None, "", "\n\n", "one two", TEXT * 1 + "Another line follows here, and it is also fine.\n" * 1, TEXT * 30,
    "Home | About | Contact | Help\n" + " ".join(f"w{i}" for i in range(60)) + ".", "a b c d e f g h " * 10, "x\r\ny\r\n" * 20,
    "$$$ %% ### " * 20, "é ß “quoted words here and there and on and on until the line is long enough for the rules to pass”\n" * 1,
    "\n".join(f"item {i}" for i in range(40)), "short\n" + TEXT + "\x0bodd \x1c blanks\n" + "All rights reserved by us\n" + " ".join(["word"] * 9),
    TEXT + "Nav » Sub » Here\n" + " ".join(f"z{i}" for i in range(30)) + "…", "tail without end " + " ".join(map(str, range(40))),
]


def test_counts_verdict_and_cleaned_text(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    docs += [(-1 - i, t) for i, t in enumerate(CASES)] + [(-50, TEXT * 30)] * 2
    rows = [(i, t, "clash") for i, t in docs]
    got = clean(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(docs)
    by = dict(docs)
    for r in got:
        want, (kept, text) = quality_counts(by[r.doc_id]), line_verdict(by[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.doc_id
        assert (r.kept, r.clean_text) == (kept, text), r.doc_id
        assert r.text == by[r.doc_id]


def test_no_rows_and_names(spark):
    df = spark.createDataFrame([], "text string, n_words string, other int")
    out = clean(df, cleaned=None)
    assert out.collect() == [] and out.columns.count("n_words") == 1 and "other" in out.columns
    assert clean(spark.createDataFrame([(TEXT,)], "text string")).select(F.col("n_words")).first()[0] == 11


def test_a_phrase_across_a_border_is_none(spark):
    """Verdicts depend on the document alone: neither the next line nor the next document in a batch takes part."""
    long = " ".join(f"word{i}" for i in range(24)) + "."
    texts = [long + "\nfor more of it please click", " here is the rest of the sentence that was begun before it, with words enough to be kept as a document.",
             long + "\nhome |", " | about us and all of our other friends, who are many and who have written much about it in the last year.",
             "read\nmore of these lines and lines that say something, until there are more than twenty words in the whole of this text.",
             long + " log", " in the evening he wrote a letter to his brother, and then another one to his sister, who lived in the north."]
    rows = [(i, t) for i, t in enumerate(texts)]
    apart = {i: clean(spark.createDataFrame([r], "doc_id long, text string")).first() for i, r in enumerate(rows)}
    for order in (rows, rows[::-1]):
        for r in clean(spark.createDataFrame(order, "doc_id long, text string").coalesce(1)).collect():
            assert r == apart[r["doc_id"]]
            kept, text = line_verdict(r["text"])
            assert (r["kept"], r["clean_text"]) == (kept, text)

import hashlib
import re
import time

import pyarrow as pa

from tracelake.llm.blocks import Texts
from tracelake.llm.crf import KINDS, LABELS, _examples, labelled_table, luhn, train
from tracelake.llm.personal import base_spans, default_model, find, find_spans, mask

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = (True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else True,
                  14 <= len(d) <= 19 and luhn(d), 10 <= len(d) <= 15)[k]
            if ok:
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


TEXTS = [
    "", None, "a@b", "x.y@z.w.", "é a@b.co, c@d.e-f.g@h.i", "a@@b.c d@e..f", "@a.b.c", "1.2.3.4.5 300.1.1.1 1.1.1.1", "4111 1111 1111 1111",
    "4111-1111-1111-1111 4111111111111112", "+1 (543) 555-1435.", "+1.2.3.4.5.6.7.8.9.0 x", "++12 345 678 90 12", "a@b.c@d.e a%b@c-d.e",
    "4451718024887799 27.65.93.", "é" * 30 + " jörg@beispiel.example", "tel (415) 555-0188 end", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8",
]


def test_patterns_match_the_plain_regex(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    for t in [*TEXTS, *(r.text for r in docs)]:
        assert base_spans(t or "") == brute(t), t


def test_digest_and_model_spans(spark):
    rows = list(enumerate(TEXTS)) + [(99, TEXTS[10]), (99, TEXTS[10])]
    got = find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        t = dict(rows)[r.doc_id]
        base = brute(t)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for *_, k in base) for i in range(4)]
        assert set(",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in base).split(",")) <= set(r.spans.split(",")) | {""}
    by = {r.doc_id: r.spans for r in got}
    assert by[15] == "email:33:52" and by[16] == "phone:4:18" and by[14].startswith("card:0:16")


def test_held_out_accuracy():
    rows = labelled_table()
    model = train([r for i, r in enumerate(rows) if i % 4])
    xs, ys = _examples([r for i, r in enumerate(rows) if i % 4 == 0])
    paths = model.decode(xs)
    right = sum(int((p == y).sum()) for p, y in zip(paths, ys))
    assert right / sum(map(len, ys)) > 0.85


def test_viterbi_is_the_best_path():
    import itertools

    model = default_model()
    run = ["(d3)", "d3-d4", "d4"]
    best = max(itertools.product(range(len(LABELS)), repeat=3), key=lambda p: model.moves[0][p[0]] + sum(
        model.emission(s)[y] for s, y in zip(run, p)) + model.moves[p[0]][p[1]] + model.moves[p[1]][p[2]] + model.moves[p[2]][0])
    assert tuple(model.decode([run, ["d4"]])[0]) == best


def test_mask_keeps_rows_and_columns(spark):
    rows = [(1, "mail a@b.co or +1 (543) 555-1435, bye", "s"), (2, None, None), (3, "", "s"), (4, "clean text 2024", "s")]
    got = mask(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    assert [tuple(r) for r in got] == [(1, "mail [EMAIL] or [PHONE], bye", "s"), *rows[1:]]
    assert find(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert find_spans(default_model(), Texts.of(pa.array(["no marks here"]))) == [[]]


def test_very_long_runs_of_digits_take_linear_time(spark):
    million = 10 ** 6
    texts = ["9" * 5000 + ".1.1.1", "0" * 5000 + "1.1.1.1", "9" * million, "9" * million + ".", "1.2.3.²", "x 1.2.3.² 1.2.3.4", "1 " * (million // 10),
             "+1" + " " * million, "1.1." * 50_000, "a" * million + "@", "7" * million + "@a.b"]
    begin = time.process_time()
    for t in texts:
        base_spans(t)
    assert time.process_time() - begin < 10
    begin = time.time()
    got = {r["doc_id"]: r for r in find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert time.time() - begin < 60
    assert got[0]["n_ip"] == 0 and got[1]["n_ip"] == 1 and got[5]["n_ip"] == 1
    assert mask(spark.createDataFrame([(1, texts[1])], "doc_id long, text string")).first()["text"] == "[IP]"


def test_long_numbers_match_the_plain_patterns():
    for t in ("9" * 300 + ".1.1.1", "0" * 300 + "255.1.1.1 x", "1.1.1.1" * 20, "12.34.56.78.90.12.34.56.78", "1.1.1.256.1.1.1.1", "x1.2.3.4y5.6.7.8"):
        assert base_spans(t) == brute(t)

import re

import pyarrow as pa
import pytest

from tracelake.llm.licences import BODIES, PHRASES, TEMPLATES, Matcher, all_templates, compile_template, scan, words_of
from tracelake.llm.blocks import Texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(text):
    w = WORD.findall(low(text))
    places = [(i, label) for p, label in PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    return len(w), sorted(places)


def variants(markup):
    """The wording with all optional regions in, and with all of them out."""
    full = re.sub(r"<<(begin|end)Optional>>", " ", markup)
    bare = markup
    while "<<beginOptional>>" in bare:
        bare = re.sub(r"<<beginOptional>>(?:(?!<<beginOptional>>).)*?<<endOptional>>", " ", bare, flags=re.S)
    fill = lambda m: " ".join(["any"] * int(m[1]))
    return [re.sub(r"<<var;\w+;(\d+);\d+>>", fill, v) for v in (full, bare)]


def test_templates_accept_their_own_wording_only():
    """Every mandatory word counts: one left out, one more or one changed, wherever it stands, is not accepted as a whole."""
    for label, markup in all_templates():
        a = compile_template(label, markup)
        for text in variants(markup):
            w = words_of(text)
            assert a.longest(w) == len(w), (label, text[:80])
        bare = words_of(variants(markup)[1])
        fixed = [i for i, x in enumerate(bare) if x != b"any" and not (0 < i < len(bare) - 1 and b"any" in (bare[i - 1], bare[i + 1]))]
        for i in fixed[::max(1, len(fixed) // 40)] + fixed[-1:]:
            assert a.longest([*bare[:i], b"zzz", *bare[i + 1:]]) == 0, (label, bare[i])
            if ";0;" not in markup:  # else a word may stand there
                assert a.longest([*bare[:i], b"zzz", *bare[i:]]) == 0, (label, bare[i])
            if b"any" not in bare[max(0, i - 1):i + 2] and bare[i] != bare[min(i + 1, len(bare) - 1)] or i == len(bare) - 1:
                assert a.longest([*bare[:i], *bare[i + 1:]]) == 0, (label, i, bare[i])


def labels(*texts):
    return Matcher(all_templates())(Texts.of(pa.array(texts)))["labels"]


def test_altered_licenses_are_not_accepted():
    whole = {label: " ".join(variants(markup)[0].split()) for label, markup in reversed(all_templates()[:8])}
    assert set(whole) == {"mit", "mit-0", "isc", "0bsd", "bsd-2-clause", "bsd-3-clause", "zlib", "unlicense"}
    for label, text in whole.items():
        assert labels(f"Copyright 2020. {text}. Written by hand.") == [label]
    assert labels(whole["zlib"].split("Permission")[0] + " You may NOT use it at all.") == [""]
    assert labels(whole["mit"].replace("without restriction", "with restriction")) == [""]
    assert labels(whole["mit"].split("THE SOFTWARE IS PROVIDED")[0]) == [""]
    assert labels(whole["isc"].replace("with or without fee", "without fee")) == [""]
    assert labels(whole["bsd-3-clause"].replace("ARE DISCLAIMED", "ARE GIVEN")) == [""]


def test_bodies_and_notices():
    bodies = dict(all_templates()[-len(BODIES):])
    assert labels(*bodies.values()) == list(bodies)
    assert labels(*[t.replace("copyright", "copy", 3) if "copyright" in t else t.replace("Program", "Thing", 1) for t in bodies.values()]).count("") >= len(bodies) - 1
    notice = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under the License."""
    found = Matcher(all_templates())(Texts.of(pa.array([notice, "x " + notice[:60]])))
    assert found["labels"] == ["apache-2", "apache-2"]
    assert found["matches"][0] == [{"first_word": 0, "end_word": len(words_of(notice)), "label": "apache-2"}]  # the short notice lies in the long one
    assert labels("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by"
                  " the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that"
                  " it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"
                  " Affero General Public License for more details.",
                  "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under the GNU Lesser General Public License v2.1") == [
        "agpl-3", "cc-by-sa", "lgpl-2.1"]


def test_fixed_phrases_are_the_contracts():
    texts = ["Given UNDER the MIT License, under the\nmit-license", "The MIT License", "under the MIT licenses", "Apache License, Version 2.0; CC-BY-NC", None]
    got = Matcher(all_templates())(Texts.of(pa.array(texts)))
    assert got["n_words"] == [9, 3, 4, 8, 0]
    assert got["n_base"] == [2, 0, 0, 2, 0]
    assert got["first_word"] == [1, None, None, 0, None] and got["last_word"] == [5, None, None, 5, None]
    assert got["base_labels"] == ["mit", "", "", "apache-2,cc-by-nc", ""]
    assert got["labels"] == ["mit", "mit", "", "apache-2,cc-by-nc", ""]  # a name alone is the method's


def test_repeated_rows_and_null_ids(spark):
    text = variants(TEMPLATES[0][1])[0]
    rows = [(1, text), (1, text), (None, text), (None, None), (2, text[:-9] + "x")]
    got = scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["labels"]) for r in got) == [("1", "mit"), ("1", "mit"), ("2", ""), ("None", ""), ("None", "mit")]


def test_optional_and_replaceable_regions():
    a = compile_template("x", "one two three <<beginOptional>>four <<beginOptional>>five<<endOptional>><<endOptional>> six <<var;v;1;2>> end")
    ok = lambda t: a.longest(words_of(t)) == len(words_of(t))
    assert ok("one two three six a end") and ok("one two three four six a b end") and ok("One, two-three four five six a end")
    assert not ok("one two three five six a end") and not ok("one two three six end") and not ok("one two three six a b c end")
    for bad in ("<<beginOptional>>a<<endOptional>>", "a b c <<beginOptional>>", "a b <<endOptional>>", "a b c <<what>>"):
        with pytest.raises(ValueError):
            compile_template("x", bad)


def test_scan(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    docs += [(-1, None), (-2, ""), (-3, "The MIT License the mit\nlicense"), (-4, variants(TEMPLATES[0][1])[0]),
             (-5, "CC-BY-NC cc by"), (-6, "the mit licenses"), (-7, "under The MIT Lıcense é")]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        n, places = brute(t)
        r = got[i]
        at = [p for p, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(at), min(at, default=None), max(at, default=None)), (i, t)
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert got[-4].labels == "mit" and got[-4].score > 0.9 and got[-1].score == 0
    assert scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []

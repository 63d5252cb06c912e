import re

from scorecast.llm import licenses as L
from scorecast.llm import queries


def norm(s):
    return re.sub(r"[\W_]+", " ", s.lower()).strip()


def brute(text):
    known = {v: k for k, v in L.SENTENCES.items()}
    forms = []
    for pat in (r"[\n\r]+|(?<=\.)\s+", r"(?<=\.)\s+"):
        forms.append([known[norm(s)] for s in re.split(pat, text or "") if norm(s) in known])
    ids = forms[1] if len("  ".join(forms[1])) > len("  ".join(forms[0])) else forms[0]
    left, out = list(ids), {}
    for lic, seq in L.RULES:
        i = 0
        while i + len(seq) <= len(left):
            if left[i:i + len(seq)] == seq:
                left[i:i + len(seq)] = [None]
                out[lic] = out.get(lic, 0) + 1
            i += 1
    rest = sum(x is not None for x in left)
    if rest:
        out["unresolved"] = rest
    return out


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
TEXTS = [MIT, "Intro.\n" + MIT + "\n\nEnd.", "Foo.\nReleased under the MIT License.\nbar", "Licensed under CC BY-NC 4.0.",
         "foo. Licensed under the Apache License, Version 2.0. Licensed under the Apache License, Version 2.0.",
         "LICENSED!! UNDER!! CC BY-SA 4.0", "See the GNU General Public License for more details.",
         "licensed under nothing", "", None, "This work is licensed under the GNU General Public License, version 3.\n" * 50]


def test_marks_cover_sentences():
    for s in L.SENTENCES.values():
        assert any(m in s for m in L.MARKS), s
        assert s == norm(s)
    assert {i for _, seq in L.RULES for i in seq} <= set(L.SENTENCES)


def rows(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], {})[r["license_id"]] = r["n_matches"]
    return out


def test_rules_against_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = rows(L.scan_licenses(df))
    for i, t in enumerate(TEXTS):
        assert got.get(i, {}) == brute(t), (i, t and t[:50])
    assert got[0] == {"MIT": 1} and got[1] == {"MIT": 1} and got[10] == {"GPL-3.0": 50}


def test_query_and_edges(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = rows(queries.op4_license_scan(spark, sf))
    assert got == {d["doc_id"]: brute(d["text"]) for d in docs if brute(d["text"])}
    assert L.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = spark.createDataFrame([(None, TEXTS[2], 1), (None, TEXTS[2], 1)], "doc_id long, text string, license_id int")
    assert [(r["doc_id"], r["n_matches"]) for r in L.scan_licenses(odd).collect()] == [(None, 2)]

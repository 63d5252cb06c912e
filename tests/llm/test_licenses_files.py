"""Complete licence files and notices, with headings, list marks and comments."""

from tests.llm.test_licenses import MIT, TEXTS, norm, rows

from scorecast.llm import licenses as L

HEAD = "Some Project\n\nCopyright (c) 2020 Some Body\n"
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

%s Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

%s Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
THIRD = """
%s Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
FILES = [
    ("MIT License\n\nCopyright (c) 2020 Some Body\n\n" + MIT, {"MIT": 1}),
    (HEAD + APACHE, {"Apache-2.0": 1}),
    (HEAD + "\n".join("# " + x for x in APACHE.split("\n")), {"Apache-2.0": 1}),
    (HEAD + GPL, {"GPL-3.0-or-later": 1}),
    ("Released under the MIT License\n" + GPL, {"MIT": 1, "GPL-3.0-or-later": 1}),
    (HEAD + BSD % ("1.", "2.", ""), {"BSD-2-Clause": 1}),
    (HEAD + BSD % ("(a)", "(b)", THIRD % "(c)"), {"BSD-3-Clause": 1}),
    (HEAD + BSD % ("1)", "2)", THIRD % "3)"), {"BSD-3-Clause": 1}),
    (HEAD + BSD % ("*", "*", THIRD % "*"), {"BSD-3-Clause": 1}),
    ("                                 Apache License\n                           Version 2.0, January 2004\n\n" + APACHE, {"Apache-2.0": 2}),
    ("This work is licensed under the GNU General Public License, version\n2. And more", {"GPL-2.0": 1}),
    ("Not released under the MIT License at all", {}),
    ("Released under the MIT License\x01|\nReleased under\r\nthe MIT License.\tX", {"MIT": 2}),
]


def test_complete_files(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(FILES)], "doc_id long, text string")
    got = rows(L.scan_licenses(df))
    for i, (t, want) in enumerate(FILES):
        assert got.get(i, {}) == want, (i, t[:60])


def test_both_cuts_in_order(spark):
    text = "Released under the MIT License\n" + GPL
    r = L.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["identifiers"] == "mit-named gpl-free gpl-hope gpl-see"


def test_every_sentence_alone(spark):
    df = spark.createDataFrame(list(SENT := [(i, v) for i, v in enumerate(L.SENTENCES.values())]), "doc_id long, text string")
    got = {r["doc_id"]: r["identifiers"] for r in L.scan_licenses(df).collect()}
    assert got == dict(enumerate(L.SENTENCES)) and all(norm(v) == v for _, v in SENT) and TEXTS

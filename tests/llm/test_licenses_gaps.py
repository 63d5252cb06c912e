"""No rule reaches over an unknown sentence; holder names; further notices."""

from scorecast.llm import licenses as L

HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """
3. Neither the name of Acme Inc. nor the names of its contributors may be used
   to endorse or promote products derived from this software without specific
   prior written permission.
"""
OTHER = """
3. All users must send a postcard to the village of the authors.
"""
TAIL = """
THIS SOFTWARE IS PROVIDED BY ACME INC. AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT OWNER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED
TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
CASES = [
    (HEAD + THIRD + TAIL, {"BSD-3-Clause": 1}),
    (HEAD + TAIL, {"BSD-2-Clause": 1}),
    ("This project is licensed under the MIT License.", {"MIT": 1}),
    ("Released under the MIT License, see LICENSE.", {"MIT": 1}),
    ("# SPDX-License-Identifier: BSD-3-Clause\n", {"BSD-3-Clause": 1}),
    ("// SPDX-License-Identifier: GPL-2.0-only", {"GPL-2.0-only": 1}),
    ("/* SPDX-License-Identifier: Apache-2.0 OR MIT */", {"Apache-2.0 OR MIT": 1}),
    ("Creative Commons Attribution 4.0 International License", {"CC-BY-4.0": 1}),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)] + [(99, HEAD + OTHER + TAIL)],
                               "doc_id long, text string")
    got = {}
    for r in L.scan_licenses(df).collect():
        got.setdefault(r["doc_id"], {})[r["license_id"]] = r["n_matches"]
    for i, (_, want) in enumerate(CASES):
        assert got.get(i) == want, i
    # the foreign clause stands between: the full two-clause rule must not reach over it
    assert got[99]["unresolved"] == 2

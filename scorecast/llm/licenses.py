"""Licence recognition by sentences and ordered rules (built-in functions only).

A text is cut at line ends, after full stops and after the list marks of lines
(``1.``, ``2)``, ``(c)``); the pieces are normalised (lower case, runs of other
characters than letters and digits become one blank). A known licence sentence
is a run of whole pieces with its words, so it may be wrapped over lines or
paragraphs and stand below a heading; where several start with one piece the
longest is taken. Holder names inside sentences (``SLOTS``) may be any words. The identifiers
of a text, in order, are then matched against ordered rules: a rule is a sequence
of identifiers that must stand side by side, with no unknown piece (but list marks)
between them; rules are tried in their order (longest first) and take their
identifiers away from later ones.

Defined results
  * null or empty text, and texts without a known sentence: no row;
  * known sentences that no rule takes are reported as ``unresolved``;
  * null ids are kept; rows with the same id and the same known sentences are
    added up;
  * an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: identifier -> normalised sentence
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mit-named": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "apache-licensed": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-copy-https": "you may obtain a copy of the license at https www apache org licenses license 2 0",
    "apache-title": "apache license version 2 0 january 2004",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "apache-named": "licensed under the apache license version 2 0",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "gpl2-copy": "you should have received a copy of the gnu general public license along with this program if not write to the free software foundation inc 51 franklin street fifth floor boston ma 02110 1301 usa",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "lgpl-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-see": "see the gnu lesser general public license for more details",
    "agpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-see": "see the gnu affero general public license for more details",
    "agpl-copy": "you should have received a copy of the gnu affero general public license along with this program",
    "gpl3-named": "this work is licensed under the gnu general public license version 3",
    "gpl2-named": "this work is licensed under the gnu general public license version 2",
    "bsd-allowed": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-liability": "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "mpl-terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "isc-liability": "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-nd": "licensed under cc by nd 4 0",
    "cc0": "this work is dedicated to the public domain under cc0 1 0",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache": "spdx license identifier apache 2 0",
    "spdx-gpl3": "spdx license identifier gpl 3 0 or later",
    "mit-project": "this project is licensed under the mit license",
    "mit-software": "this software is licensed under the mit license",
    "mit-see": "released under the mit license see license",
    "gpl2-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl3-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "cc-by-long": "creative commons attribution 4 0 international license",
    "cc-by-sa-long": "creative commons attribution sharealike 4 0 international license",
    "spdx-apache-or-mit": "spdx license identifier apache 2 0 or mit",
    "spdx-mit-or-apache": "spdx license identifier mit or apache 2 0",
    "spdx-bsd2": "spdx license identifier bsd 2 clause",
    "spdx-bsd3": "spdx license identifier bsd 3 clause",
    "spdx-gpl2-only": "spdx license identifier gpl 2 0 only",
    "spdx-gpl2": "spdx license identifier gpl 2 0 or later",
    "spdx-gpl3-only": "spdx license identifier gpl 3 0 only",
    "spdx-lgpl21": "spdx license identifier lgpl 2 1 or later",
    "spdx-agpl3": "spdx license identifier agpl 3 0 or later",
    "spdx-mpl2": "spdx license identifier mpl 2 0",
    "spdx-isc": "spdx license identifier isc",
}

# fixed values: licence -> sequence of identifiers; tried in this order
RULES = [
    ("MIT", ["mit-grant", "mit-warranty", "mit-liability"]),
    ("Apache-2.0", ["apache-licensed", "apache-copy", "apache-as-is", "apache-see"]),
    ("Apache-2.0", ["apache-licensed", "apache-copy-https", "apache-as-is", "apache-see"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-see", "gpl-copy"]),
    ("AGPL-3.0-or-later", ["agpl-free", "gpl-hope", "agpl-see", "agpl-copy"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-see", "gpl2-copy"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-see", "gpl-copy"]),
    ("LGPL-2.1-or-later", ["lgpl-free", "lgpl-hope", "lgpl-see"]),
    ("BSD-3-Clause", ["bsd-allowed", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is", "bsd-liability"]),
    ("BSD-2-Clause", ["bsd-allowed", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liability"]),
    ("BSD-3-Clause", ["bsd-allowed", "bsd-source", "bsd-binary", "bsd-names"]),
    ("ISC", ["isc-grant", "isc-as-is", "isc-liability"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-see"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-see"]),
    ("AGPL-3.0-or-later", ["agpl-free", "gpl-hope", "agpl-see"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope"]),
    ("BSD-2-Clause", ["bsd-allowed", "bsd-source", "bsd-binary"]),
    ("MPL-2.0", ["mpl-terms", "mpl-copy"]),
    ("Apache-2.0", ["apache-licensed"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("AGPL-3.0-or-later", ["agpl-free"]),
    ("LGPL-2.1-or-later", ["lgpl-free"]),
    ("MPL-2.0", ["mpl-terms"]),
    ("MIT", ["mit-grant"]),
    ("ISC", ["isc-grant"]),
    ("MIT", ["mit-named"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["spdx-mit"]),
    ("Apache-2.0", ["apache-named"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("Apache-2.0", ["apache-title"]),
    ("GPL-3.0", ["gpl3-title"]),
    ("GPL-2.0", ["gpl2-title"]),
    ("GPL-3.0", ["gpl3-named"]),
    ("GPL-2.0", ["gpl2-named"]),
    ("GPL-3.0-or-later", ["spdx-gpl3"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-ND-4.0", ["cc-by-nd"]),
    ("CC0-1.0", ["cc0"]),
    ("GPL-2.0-only", ["gpl2-only", "gpl-hope", "gpl-see"]),
    ("GPL-3.0-only", ["gpl3-only", "gpl-hope", "gpl-see"]),
    ("GPL-2.0-only", ["gpl2-only"]),
    ("GPL-3.0-only", ["gpl3-only"]),
    ("MIT", ["mit-project"]),
    ("MIT", ["mit-software"]),
    ("MIT", ["mit-see"]),
    ("CC-BY-4.0", ["cc-by-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-long"]),
    ("Apache-2.0 OR MIT", ["spdx-apache-or-mit"]),
    ("MIT OR Apache-2.0", ["spdx-mit-or-apache"]),
    ("BSD-2-Clause", ["spdx-bsd2"]),
    ("BSD-3-Clause", ["spdx-bsd3"]),
    ("GPL-2.0-only", ["spdx-gpl2-only"]),
    ("GPL-2.0-or-later", ["spdx-gpl2"]),
    ("GPL-3.0-only", ["spdx-gpl3-only"]),
    ("LGPL-2.1-or-later", ["spdx-lgpl21"]),
    ("AGPL-3.0-or-later", ["spdx-agpl3"]),
    ("MPL-2.0", ["spdx-mpl2"]),
    ("ISC", ["spdx-isc"]),
]

# fixed values: before, after and replacement of holder names inside sentences
SLOTS = [
    ("neither the name of", "nor the names of its contributors", "the copyright holder"),
    ("this software is provided by", "as is and any express", "the copyright holders and contributors"),
    ("in no event shall", "be liable for any direct indirect", "the copyright holder or contributors"),
]

# every known sentence holds one of these letter runs, and so does a text with one
MARKS = ("licen", "copyright", "warrant", "redistribut", "mpl", "cc0", "liab")


CUT = "\x01"  # between the pieces of a text
GAP = "~"     # stands for unknown pieces; no rule holds it
LIST_MARK = r"(?m)^([^\p{L}\p{N}\n\r]*(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})[.)])\s+"


def pieces(text: Column) -> Column:
    """The normalised pieces of a text, each framed by ``CUT``."""
    t = F.regexp_replace(F.lower(F.translate(text, CUT, " ")), LIST_MARK, f"$1{CUT}")
    t = F.regexp_replace(F.regexp_replace(t, r"[\n\r]+|(?<=\.)\s+", CUT), rf"[^\p{{L}}\p{{N}}{CUT}]+", " ")
    return F.regexp_replace(F.concat(F.lit(CUT), t, F.lit(CUT)), f" ?{CUT}[ {CUT}]*", CUT)


def _named(framed: Column) -> Column:
    """Holder names of up to 120 characters as the known sentences write them."""
    for before, after, name in SLOTS:
        b, a = (x.replace(" ", f"[ {CUT}]") for x in (before, after))
        framed = F.regexp_replace(framed, f"(?<={CUT}){b}[ {CUT}].{{1,120}}?[ {CUT}]{a}(?=[ {CUT}])",
                                  f"{before} {name} {after}")
    return framed


def _identifiers(text: Column) -> Column:
    """Space-framed identifiers of the known sentences, in order; ``GAP`` where
    unknown pieces stand."""
    known = F.create_map(*[F.lit(x) for k, v in SENTENCES.items() for x in (v, k)])
    longest = sorted(SENTENCES.values(), key=lambda v: (-len(v), v))
    any_of = "|".join(v.replace(" ", f"[ {CUT}]") for v in longest)
    found = F.regexp_extract_all(_named(pieces(text)), F.lit(f"(?<={CUT})(?:{any_of}|[^{CUT}]+)(?={CUT})"), 0)
    ids = F.transform(F.filter(found, lambda s: ~s.rlike("^(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})$")),
                      lambda s: F.coalesce(F.try_element_at(known, F.translate(s, CUT, " ")), F.lit(GAP)))
    framed = F.concat(F.lit(" "), F.array_join(ids, "  "), F.lit(" "))
    return F.regexp_replace(framed, f"(?: {GAP} )+", f" {GAP} ")


def _matched(sequence: Column) -> Column:
    """struct(left, found): identifiers no rule took; array of (licence, n)."""
    rules = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(" " + "  ".join(v) + " ").alias("ids"))
                      for k, v in RULES])
    start = F.struct(sequence.alias("left"),
                     F.array().cast("array<struct<license:string,n:int>>").alias("found"))

    def take(acc: Column, rule: Column) -> Column:
        rest = F.replace(acc["left"], rule["ids"], F.lit("|"))
        n = F.size(F.split(acc["left"], F.concat(F.lit(r"\Q"), rule["ids"], F.lit(r"\E")), -1)) - 1
        return F.when(F.contains(acc["left"], rule["ids"]), F.struct(
            rest.alias("left"),
            F.concat(acc["found"], F.array(F.struct(rule["license"].alias("license"), n.alias("n")))).alias("found"))
        ).otherwise(acc)

    return F.aggregate(rules, start, take)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license_id, n_matches, identifiers): one row per text and
    recognised licence; ``identifiers`` are the text's known sentences."""
    low = F.lower(F.col("t"))
    marked = F.lit(False)
    for m in MARKS:
        marked = marked | low.contains(m)
    src = (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
           .filter(marked))
    known = (src.select("doc_id", _identifiers(F.col("t")).alias("gapped"))
             .withColumn("ids", F.replace(F.col("gapped"), F.lit(f" {GAP} "), F.lit(""))).filter(F.trim("ids") != ""))
    found = known.select("doc_id", "ids", _matched(F.col("gapped")).alias("m"))
    rest = F.size(F.filter(F.split(F.replace(F.col("m.left"), F.lit("|"), F.lit(" ")), " +"), lambda x: ~x.isin("", GAP)))
    unresolved = F.when(rest > 0, F.array(F.struct(F.lit("unresolved").alias("license"), rest.alias("n")))).otherwise(
        F.array().cast("array<struct<license:string,n:int>>"))
    return (found.select("doc_id", "ids", F.explode(F.concat("m.found", unresolved)).alias("x"))
            .groupBy("doc_id", "ids", F.col("x.license").alias("license_id"))
            .agg(F.sum("x.n").alias("n_matches"))
            .select("doc_id", "license_id", "n_matches",
                    F.regexp_replace(F.trim("ids"), " +", " ").alias("identifiers")))

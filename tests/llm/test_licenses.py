import duckdb
import pytest

from millrace.llm import licenses
from millrace.llm.queries import ORACLE_SQL, QUERIES

from cases import SMALL, edge_docs, no_docs

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""


MIT_REST = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program{}
"""
GPL2 = GPL.format(";", ";", 2, "; if not, write to the Free Software Foundation, Inc.,\n51 Franklin Street.")
GPL3 = GPL.format(":", ",", 3, ".  If not, see <https://www.gnu.org/licenses/>.")
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MPL = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy was not distributed, get one."
GPL_ALL = ["{}-GRANT", "GPL-HOPE", "GPL-COPY"]
VERBATIM = [
    (MIT + MIT_REST, "MIT", ["MIT-GRANT", "MIT-NOTICE", "MIT-AS-IS", "MIT-LIABILITY"]),
    (APACHE, "Apache-2.0", ["APACHE2-NAME", "APACHE2-COMPLIANCE", "APACHE2-COPY", "APACHE2-AS-IS", "APACHE2-LANGUAGE"]),
    (GPL2, "GPL-2.0-or-later", [i.format("GPL2") for i in GPL_ALL]),
    (GPL3, "GPL-3.0-or-later", [i.format("GPL3") for i in GPL_ALL]),
    (BSD2, "BSD-2-Clause", ["BSD-GRANT", "BSD-SOURCE", "BSD-BINARY"]),
    ("All rights reserved.\n\n" + BSD3, "BSD-3-Clause", ["ALL-RIGHTS", "BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE"]),
    (ISC, "ISC", ["ISC-GRANT"]),
    (MPL, "MPL-2.0", ["MPL2-NAME"]),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0", ["GPL3-NAME"]),
    ("Licensed under the GNU General Public License version 2.", "GPL-2.0", ["GPL2-NAME"]),
    ("Licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0", ["LGPL3-NAME"]),
    ("// SPDX-License-Identifier: MIT\nint main;", "MIT", ["MIT-NAME"]),
    ("# SPDX-License-Identifier: BSD-3-Clause\n", "BSD", ["BSD-NAME"]),
    ("This work is licensed under a Creative Commons\nAttribution 4.0 International License.", "CC-BY-4.0", ["CC-BY-NAME"]),
    ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0", ["CC-BY-SA-NAME"]),
    ("Licensed under CC BY-NC 4.0; do ask.", "CC-BY-NC-4.0", ["CC-BY-NC-NAME"]),
    ("(c) 2020\nAll rights reserved.", "all-rights-reserved", ["ALL-RIGHTS"]),
]


def commented(text, sign):
    return "".join(f"{sign}{line}\n" for line in text.split("\n"))


def test_verbatim_notices_of_every_rule(spark):
    assert {n for _, n, _ in VERBATIM} == {n for n, _ in licenses.RULES}
    signs = ["", " * ", "# ", "// ", "    "]
    rows = [(k, commented(t, sign) if sign else t) for k, (t, _, _) in enumerate(VERBATIM) for sign in signs]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in licenses.scan(df).collect():
        _, name, sentences = VERBATIM[r["doc_id"]]
        assert (r["licenses"], r["sentences"]) == ([name], sentences)


def found(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["licenses"] for r in licenses.scan(df).orderBy("doc_id").collect()]


def test_rules(spark):
    comment = "".join(f" * {line}\n" if k else f"/* {line}\n" for k, line in enumerate(MIT.split("\n")))
    got = found(
        spark,
        MIT,
        comment,
        "Licensed under the Apache License, Version 2.0. You may obtain a copy of the License at\nhttp://x",
        "x. Licensed under CC BY-NC 4.0. y\nReleased under the MIT License.\nReleased under the MIT License!",
        "SPDX-License-Identifier: Apache-2.0\nAll rights reserved.",
        "Permission is hereby granted.",
        "licence",
        None,
    )
    assert got == [["MIT"], ["MIT"], ["Apache-2.0"], ["MIT", "CC-BY-NC-4.0"], ["Apache-2.0", "all-rights-reserved"], [], [], []]


def test_parts_of_a_full_text_are_not_reported_again(spark):
    rule = dict((n, r) for n, r in licenses.RULES)["BSD-3-Clause"]
    known = {i: s for s, i in licenses.SENTENCES.items()}
    text = ". ".join(known[i.rstrip("?")] for i in rule)
    assert found(spark, text + ".", text.rsplit(". ", 1)[0]) == [["BSD-3-Clause"], ["BSD-2-Clause"]]


def test_every_known_sentence_is_normal_and_has_a_trigger(spark):
    assert all(any(t in s for t in licenses.TRIGGERS) for s in licenses.SENTENCES)
    df = spark.createDataFrame([(s,) for s in licenses.SENTENCES], "text string")
    got = {r["text"]: r["i"] for r in df.select("text", licenses.identified(df["text"]).alias("i")).collect()}
    assert got == {s: [i] for s, i in licenses.SENTENCES.items()}
    assert {i.rstrip("?") for _, r in licenses.RULES for i in r} == set(licenses.SENTENCES.values())


@pytest.mark.parametrize("edge", [False, True])
def test_query_equals_sql(spark, tmp_path, edge):
    path, folder = f"{SMALL}/documents.parquet", SMALL
    if edge:
        folder = str(tmp_path)
        texts = [MIT, MIT + "All rights reserved.\n" * 3, *(t for t, _, _ in VERBATIM), *(commented(t, " * ") for t, _, _ in VERBATIM)]
        more = spark.createDataFrame([(50 + k, t, "en", "a", 1) for k, t in enumerate(texts)], edge_docs(spark).schema)
        edge_docs(spark).unionAll(more).write.parquet(f"{folder}/documents.parquet")
        path = f"{folder}/documents.parquet/*.parquet"
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{path}'")
    want = db.execute(ORACLE_SQL["op5_license_scan"]).fetchall()
    assert sorted(map(tuple, QUERIES["op5_license_scan"](spark, folder).collect()), key=str) == sorted(want, key=str)
    assert any(r[2] for r in want)


def test_edge_cases(spark):
    docs = edge_docs(spark, clashes=True)
    assert licenses.scan(docs).count() == docs.count()
    out = licenses.with_licenses(docs)
    assert out.columns == [c for c in docs.columns if c != "licenses"] + ["licenses"]
    assert {tuple(r["licenses"]) for r in out.collect()} == {()}
    assert licenses.scan(no_docs(spark)).collect() == []

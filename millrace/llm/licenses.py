"""Licence scan by sentences: known sentences become identifiers, rules match their order.

A text is cut into sentences, each is normalised, and those that are known get an identifier. The sequence of
identifiers is then matched against the rules in their order; what a rule has matched is taken out before the next
one is tried, so that a full text is not reported as its parts. All of it is column expressions; documents are
neither shuffled nor handed to Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import free_name, quoted

# Normalised sentences of well-known licences, and notices that name them.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MIT-GRANT",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MIT-NOTICE",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MIT-AS-IS",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MIT-LIABILITY",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISC-GRANT",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSD-GRANT",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSD-SOURCE",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSD-BINARY",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSD-ENDORSE",
    "licensed under the apache license version 2.0": "APACHE2-NAME",
    "licensed under the apache license version 2.0 the license": "APACHE2-NAME",
    "you may not use this file except in compliance with the license": "APACHE2-COMPLIANCE",
    "you may obtain a copy of the license at": "APACHE2-COPY",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "APACHE2-AS-IS",
    "see the license for the specific language governing permissions and limitations under the license": "APACHE2-LANGUAGE",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3-GRANT",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2-GRANT",
    "you should have received a copy of the gnu general public license along with this program": "GPL-COPY",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPL-HOPE",
    "this work is licensed under the gnu general public license version 3": "GPL3-NAME",
    "licensed under the gnu general public license version 3": "GPL3-NAME",
    "licensed under the gnu general public license version 2": "GPL2-NAME",
    "licensed under the gnu lesser general public license version 3": "LGPL3-NAME",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "MPL2-NAME",
    "released under the mit license": "MIT-NAME",
    "licensed under the mit license": "MIT-NAME",
    "released under the bsd license": "BSD-NAME",
    "licensed under cc by 4.0": "CC-BY-NAME",
    "licensed under cc by-sa 4.0": "CC-BY-SA-NAME",
    "licensed under cc by-nc 4.0": "CC-BY-NC-NAME",
    "this work is licensed under a creative commons attribution 4.0 international license": "CC-BY-NAME",
    "this work is licensed under a creative commons attribution-noncommercial 4.0 international license": "CC-BY-NC-NAME",
    "all rights reserved": "ALL-RIGHTS",
    "spdx-license-identifier mit": "MIT-NAME",
    "spdx-license-identifier apache-2.0": "APACHE2-NAME",
    "spdx-license-identifier gpl-3.0-only": "GPL3-NAME",
    "spdx-license-identifier bsd-3-clause": "BSD-NAME",
}
# Licences in the order their rules are tried; identifiers follow each other, "?" marks one that may lack.
RULES = (
    ("MIT", ("MIT-GRANT", "MIT-NOTICE", "MIT-AS-IS?", "MIT-LIABILITY?")),
    ("ISC", ("ISC-GRANT", "MIT-AS-IS?")),
    ("BSD-3-Clause", ("ALL-RIGHTS?", "BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE")),
    ("BSD-2-Clause", ("ALL-RIGHTS?", "BSD-GRANT", "BSD-SOURCE", "BSD-BINARY")),
    ("Apache-2.0", ("APACHE2-NAME", "APACHE2-COMPLIANCE?", "APACHE2-COPY?", "APACHE2-AS-IS?", "APACHE2-LANGUAGE?")),
    ("GPL-3.0-or-later", ("GPL3-GRANT", "GPL-HOPE?", "GPL-COPY?")),
    ("GPL-2.0-or-later", ("GPL2-GRANT", "GPL-HOPE?", "GPL-COPY?")),
    ("GPL-3.0", ("GPL3-NAME",)),
    ("GPL-2.0", ("GPL2-NAME",)),
    ("LGPL-3.0", ("LGPL3-NAME",)),
    ("MPL-2.0", ("MPL2-NAME",)),
    ("MIT", ("MIT-NAME",)),
    ("BSD", ("BSD-NAME",)),
    ("CC-BY-4.0", ("CC-BY-NAME",)),
    ("CC-BY-SA-4.0", ("CC-BY-SA-NAME",)),
    ("CC-BY-NC-4.0", ("CC-BY-NC-NAME",)),
    ("all-rights-reserved", ("ALL-RIGHTS",)),
)
# Every known sentence holds one of these; sentences without are not normalised. A test holds this against SENTENCES.
TRIGGERS = ("licen", "permi", "redistribut", "warrant", "rights reserved", "liab", "endorse", "copyright")


def rule_pattern(identifiers: tuple[str, ...]) -> str:
    """A rule over the sequence ``,A,B,C,``."""
    return "," + "".join(f"(?:{i[:-1]},)?" if i.endswith("?") else f"{i}," for i in identifiers)


# Ends of a unit; line breaks in it; those of them that are likely to be mere wrapping.
END, BREAK, WRAP = "\x02", "\x01", "\x03"


def units(text: Column) -> Column:
    """A text in units: they end at blank lines and at stops followed by white space.

    Signs that open a line of a comment are left out; the stop in "v. 2.0" ends nothing. Line breaks stay in the unit:
    as ``WRAP`` before a small letter or a bracket, as ``BREAK`` elsewhere.
    """
    body = F.regexp_replace(text, r"\n[ \t\r#*/;-]*", "\n")
    body = F.regexp_replace(body, r"\n\n+", END)
    body = F.regexp_replace(body, r"\n([a-z(])", f"{WRAP}$1")
    body = F.regexp_replace(F.lower(F.translate(body, "\n", BREAK)), r"\bv\.[ \x01\x03]+([0-9])", "v $1")
    return F.split(F.regexp_replace(body, r"([.!?]+)[ \t\r\x01\x03]+", f"$1{END}"), END, -1)


def identified(text: Column) -> Column:
    """The identifiers of the known sentences of a text, in their order.

    A unit is a sentence if it is known as a whole, its lines read on. Otherwise it is taken apart, at semicolons, then
    at line breaks, then at breaks that look like wrapping, each time only what is not known as it stands.
    """
    known = F.create_map(*(F.lit(x) for pair in SENTENCES.items() for x in pair))

    def name(part: Column) -> Column:
        plain = F.regexp_replace(F.regexp_replace(part, r"[^a-z0-9.-]+", " "), r"^[ .-]+|[ .-]+$", "")
        return F.try_element_at(known, plain)

    def names(part: Column, cuts: tuple[str, ...]) -> Column:
        if not cuts:
            return F.array(name(part))
        apart = F.flatten(F.transform(F.split(part, cuts[0], -1), lambda p: names(p, cuts[1:])))
        return F.when(name(part).isNotNull(), F.array(name(part))).otherwise(apart)

    near = F.filter(units(text), _any)
    return F.array_compact(F.flatten(F.transform(near, lambda u: names(u, (";", BREAK, WRAP)))))


def _any(text: Column) -> Column:
    found = F.lit(False)
    for trigger in TRIGGERS:
        found |= text.contains(trigger)
    return found


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, sentences, licenses`` of every row: identifiers in their order, licences in that of the rules, each once.

    Null and empty texts have none of either. Repeated rows are answered each; an empty table gives an empty
    result; other columns are not looked at.
    """
    text = F.coalesce(quoted("text"), F.lit(""))
    # Texts without a trigger word are not cut into sentences.
    rows = docs.select(quoted("doc_id").alias("doc_id"), F.when(_any(F.lower(text)), text).otherwise("").alias("text"))
    rows = rows.select("doc_id", identified(F.col("text")).alias("sentences"))
    rules = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(rule_pattern(r)).alias("pattern")) for n, r in RULES))
    sequence = F.concat(F.lit(","), F.array_join("sentences", ",,"), F.lit(","))
    # Each identifier has its own commas, so that neighbours can both be matched.
    rows = rows.withColumn("sequence", F.regexp_replace(sequence, ",,", ","))
    start = F.struct(F.col("sequence").alias("left"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        there = F.rlike(state["left"], rule["pattern"])
        return F.struct(
            F.when(there, F.regexp_replace(state["left"], rule["pattern"], F.lit(","))).otherwise(state["left"]).alias("left"),
            F.when(there, F.array_append(state["found"], rule["name"])).otherwise(state["found"]).alias("found"),
        )

    matched = F.aggregate(rules, start, step, lambda s: F.array_distinct(s["found"]))
    none = F.array().cast("array<string>")
    return rows.select("doc_id", "sentences", F.when(F.size("sentences") > 0, matched).otherwise(none).alias("licenses"))


def with_licenses(docs: DataFrame, column: str = "licenses") -> DataFrame:
    """The documents with the licences found in their text in ``column``, replaced if it is there.

    Null and empty texts have an empty list; empty tables give empty results.
    """
    row = free_name(["doc_id", "text"], "row")
    packed = docs.select(F.struct(*(quoted(c) for c in docs.columns)).alias("doc_id"), quoted("text").alias("text"))
    found = scan(packed).select(F.col("doc_id").alias(row), "licenses")
    own = [F.col(row).getField(c).alias(c) for c in docs.columns if c.lower() != column.lower()]
    return found.select(*own, F.col("licenses").alias(column))

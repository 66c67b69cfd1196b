"""Licence texts by canonical digest: whole texts, paragraphs and lines are looked up among known licences."""

from __future__ import annotations

import re
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as equal, after lower-casing, as pattern and replacement.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("authorisation", "authorization"),
    ("authorise", "authorize"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("judgement", "judgment"),
    ("non-commercial", "noncommercial"),
    ("per cent", "percent"),
    ("recognised", "recognized"),
    ("version ([0-9])", "v $1"),
    ("https://", "http://"),
]

# Short licence texts and the customary notices, by name.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

APACHE_HEADER = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
]
GNU_HEADER = [
    "This {0} is free software{4} you can redistribute it and/or modify it under the terms of the {1} as published by the Free Software Foundation{5} either version {2} of the License, or (at your option) any later version.",
    "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {1} for more details.",
    "You should have received a copy of the {1} along with this {0}. If not, see {3}.",
]
GNU = [("GPL-2.0", "program", "GNU General Public License", "2"), ("GPL-3.0", "program", "GNU General Public License", "3"), ("LGPL-2.1", "library", "GNU Lesser General Public License", "2.1"), ("LGPL-3.0", "library", "GNU Lesser General Public License", "3")]
MPL_HEADER = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at {}."

#: Larger tables of licences are joined by a shuffle.
MOST_BROADCAST = 100_000
# What makes a lower-case line one of copyright: a year, a sign, or a holder without either. A licence's
# own sentences on copyright stay.
_BEFORE = r"[^\n\p{L}\p{N}]*"
WITH_YEAR = rf"{_BEFORE}(?:copyright|\(c\)|©)[^\n]*[0-9]{{4}}[^\n]*"
WITH_SIGN = rf"{_BEFORE}(?:copyright[ \t]*(?:\(c\)|©|[\[<{{]|by )[^\n]*|©[^\n]*)"
WITH_TEAM = rf"{_BEFORE}copyright [^\n]*\b(?:authors|contributors)\.?[ \t]*"
NO_HOLDER = rf"{_BEFORE}copyright (?:holder|owner|notice)"
COPYRIGHT_LINES = rf"(?md)^(?:{WITH_YEAR}|{WITH_SIGN}|(?!{NO_HOLDER}){WITH_TEAM})$"
COPYRIGHT_SIGNS = ["copyright", "(c)", "©"]
#: Stands for a blank line between paragraphs.
BREAK = "\x02"
NOT_WORD = rf"[^\p{{L}}\p{{N}}\n{BREAK}]+"
BLANK_LINE = r"\n[ \t]*\n"


def spelled(text: Column) -> Column:
    """Lower case, copyright lines emptied, spellings made equal, punctuation and blanks as single blanks; lines stay.

    Nothing here looks past the end of a line, so the lines of the result are what each line alone would give.
    """
    out = F.lower(F.translate(F.coalesce(text, F.lit("")), BREAK, " "))
    out = F.replace(F.replace(out, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    out = F.regexp_replace(out, BLANK_LINE, f"\n{BREAK}\n")
    signs = reduce(lambda a, b: a | b, [F.contains(out, F.lit(sign)) for sign in COPYRIGHT_SIGNS])
    out = F.when(signs, F.regexp_replace(out, COPYRIGHT_LINES, "")).otherwise(out)
    for pattern, replacement in SPELLINGS:
        out = F.regexp_replace(out, pattern, replacement) if any(c in pattern for c in "[(") else F.replace(out, F.lit(pattern), F.lit(replacement))
    return F.regexp_replace(out, NOT_WORD, " ")


def _flat(spelled_: Column) -> Column:
    return F.trim(F.regexp_replace(spelled_, f"[ \n{BREAK}]+", " "))


def canonical(text: Column) -> Column:
    """The whole text on one line, spelled alike."""
    return _flat(spelled(text))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def full_texts() -> list[tuple[str, str]]:
    """The licence texts shipped in ``license_texts``: as they are, without a short title, and without an appendix."""
    found = []
    for file in sorted(resources.files("kinfold.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt"), file.read_text("utf-8")
        found.append((name, text))
        if name in ("MIT", "BSD-2-Clause", "BSD-3-Clause"):
            found.append((name, text.split("\n", 1)[1]))
        if name == "MIT":
            found.append((name, "The " + text))
        if end := re.search(r"\n *END OF TERMS AND CONDITIONS\n", text):
            found += [(name, text[: end.end()]), (name, text[: end.start()])]
    return found


def headers() -> list[tuple[str, str]]:
    """Standard headers of source files: whole, as a comment keeps them, and by the paragraph that names the licence."""
    found = [("Apache-2.0", " ".join(APACHE_HEADER)), ("Apache-2.0", APACHE_HEADER[0]), ("Apache-2.0", " ".join(APACHE_HEADER[:2]))]
    for name, kind, title, version in GNU:
        for what in {kind, "program"}:
            for link in ("http://www.gnu.org/licenses/", "http://www.gnu.org/licenses"):
                parts = [p.format(what, title, version, link, ";", ",") for p in GNU_HEADER]
                found += [(name, " ".join(parts)), (name, parts[0])]
    return found + [("MPL-2.0", MPL_HEADER.format(link)) for link in ("http://mozilla.org/MPL/2.0/", "http://www.mozilla.org/MPL/2.0/")]


def known_licenses(spark: SparkSession, notices: list[tuple[str, str]] | None = None) -> DataFrame:
    """``license, digest`` of the known texts, by default the notices, standard headers and full texts.

    A table of one's own with these columns serves as well.
    """
    notices = NOTICES + headers() + full_texts() if notices is None else notices
    table = spark.createDataFrame(notices, "license string, text string")
    return table.select("license", digest(F.col("text")).alias("digest")).distinct()


def license_scan(docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, license, unit, n_matches`` for each document, known licence and kind of unit that occurs in it.

    Units are the entire text (``text``), its paragraphs between blank lines (``paragraph``) and its lines (``line``);
    a unit matches when the SHA-256 of its canonical form is that of a known licence. A text of one paragraph or line
    is looked up as ``text`` only, a paragraph of one line as ``paragraph`` only. Blank units, and null or empty
    texts, match nothing. Repeated rows count together; an empty table gives no rows.

    A text is spelled alike once, before it is cut into units. These go through a hash join with the digests: broadcast, since the table of licences is counted first, and a
    shuffled join when it is large. Only matches are shuffled, counted per document beforehand in each task.
    """
    source = docs.select(F.col(id_column).alias("doc_id"), spelled(F.col(text_column)).alias("_text"))

    def several(unit: str, between: str) -> Column:
        parts = F.split("_text", between)
        return F.when(F.size(parts) > 1, F.transform(parts, lambda p: F.struct(F.lit(unit).alias("unit"), p.alias("body")))).otherwise(F.expr("array()"))

    whole = F.array(F.struct(F.lit("text").alias("unit"), F.col("_text").alias("body")))
    units = source.select("doc_id", F.explode(F.concat(whole, several("paragraph", BREAK), several("line", "\n"))).alias("_unit"))
    line = F.trim(F.translate(F.col("_unit.body"), BREAK, ""))
    units = units.select("doc_id", "_unit.unit", F.when(F.col("_unit.unit") == "line", line).otherwise(_flat(F.col("_unit.body"))).alias("_form")).filter("_form <> ''")
    units = units.select("doc_id", "unit", F.sha2("_form", 256).alias("digest"))
    small = known.count() <= MOST_BROADCAST
    found = units.join(F.broadcast(known) if small else known, "digest")
    return found.groupBy("doc_id", "license", "unit").agg(F.count(F.lit(1)).alias("n_matches"))

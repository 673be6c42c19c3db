"""Known licences by canonical digest: texts are normalised, hashed and joined.

Case, punctuation, white space, copyright lines and equivalent spellings do not count: what
they leave is hashed and looked up among the digests of known texts, normalised the same
way. Whole texts are looked up, and single lines as whole texts of their own. Everything is
an expression or a hash join; the table of known digests is a constant of a few dozen rows.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence texts and the notices by which licences are named.
KNOWN = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "This work is licensed under the Apache License, Version 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "MIT License\n"
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "ISC License\n"
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ],
}
#: Whole texts and headers of several lines, a file for each SPDX id; texts of one file are parted by a line of two per cent signs.
TEXTS = {file.stem: file.read_text("utf-8").split("\n%%\n") for file in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}

#: Spellings that mean the same, as patterns on lower-case text.
EQUIVALENT = [("licence", "license"), ("sub-licens", "sublicens"), ("non-?commercial", "noncommercial"), ("share-?alike", "sharealike"), ("http:", "https:"), ("&", " and ")]
COPYRIGHT_LINE = r"(?m)^[ \t*#/;-]*(?:copyright[ \t]+(?:\(c\)|©|[0-9])|©|\(c\)|all rights reserved)[^\n]*$"
#: Lines in which none of these stands cannot be a known text; see ``ALL_MARKS``.
MARKS = "license|licence|permission"
#: The same for the whole texts too, which can stand on one line.
ALL_MARKS = MARKS + "|permitted"


def canonical(text: Column) -> Column:
    """What counts of a text: words in lower case, one space between them."""
    text = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    for pattern, to in EQUIVALENT:
        text = F.regexp_replace(text, pattern, to)
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


def digest(text: Column) -> Column:
    """Digest of the canonical form; null where nothing is left."""
    form = canonical(text)
    return F.when(form != "", F.sha2(form, 256))


def known_digests(docs: DataFrame, known: dict[str, list[str]]) -> DataFrame:
    """(digest, license): one row per known text, worked out by the same expressions."""
    rows = [(name, text) for name, texts in known.items() for text in texts]
    table = docs.sparkSession.createDataFrame(rows, "license string, known string")
    return table.select(digest(F.col("known")).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def check_known(known: dict[str, list[str]]) -> None:
    """Every known text has to name a licence or a permission, so that other lines can be passed over."""
    for name, texts in known.items():
        for text in texts:
            if not any(mark in text.lower() for mark in ALL_MARKS.split("|")):
                raise ValueError(f"A text of {name} has none of {ALL_MARKS}.")


def license_scan(docs: DataFrame, text: str = "text", known: dict[str, list[str]] | None = None) -> DataFrame:
    """All rows of ``docs`` with text_digest, license and line_licenses.

    ``license`` is that of the known text which the whole text is, null if it is none;
    ``line_licenses`` are those that single lines are (sorted, each once; empty if none).
    Null and empty texts, and those of copyright lines only, have a null digest. Repeated
    rows are looked up each for itself. ``known`` is a short table of texts by licence, by
    default ``KNOWN`` and ``TEXTS``.
    Columns named like the new ones are replaced, all others stay.
    """
    known = known or {name: KNOWN.get(name, []) + TEXTS.get(name, []) for name in sorted(KNOWN.keys() | TEXTS.keys())}
    check_known(known)
    docs = docs.drop("text_digest", "license", "line_licenses")
    table = known_digests(docs, known)
    # a few dozen digests: a constant of the plan
    digests = [F.lit(value) for row in table.collect() for value in (row["digest"], row["license"])]
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda line: F.lower(line).rlike(ALL_MARKS))
    of_lines = F.transform(lines, lambda line: F.try_element_at(F.create_map(*digests), digest(line)))
    found = docs.withColumn("text_digest", digest(F.col(text))).withColumn("line_licenses", F.array_sort(F.array_distinct(F.array_compact(of_lines))))
    return found.join(F.broadcast(table.withColumnRenamed("digest", "text_digest")), "text_digest", "left").select(*docs.columns, "text_digest", "license", "line_licenses")

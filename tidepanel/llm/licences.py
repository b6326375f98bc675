"""Licence scan: canonical texts looked up by digest.

A text is normalised (A-Z lowered, punctuation and white space to single spaces, equivalent spellings to one, copyright
lines left out) and its digest is hash-joined to the digests of known licences, normalised alike. Whole texts are looked
up, and so is every line, for notices within other text. The catalogue is a short table passed by the caller, broadcast
under its fixed size. Null and empty texts match nothing; repeated rows are each reported; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepanel.llm.common import LOWER, UPPER, read, stored

PUNCTUATION = "\t\x0b\x0c\r.,;:!?'\"`()[]{}<>*#_-/\\|=+~"

# Spellings that licence texts use for the same word.
SPELLINGS = {
    "licence": "license", "licenced": "licensed", "sub license": "sublicense", "organisation": "organization",
    "recognise": "recognize", "favour": "favor", "non commercial": "noncommercial", "copyright holder": "copyright owner",
}

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)

# Whole licences and the notices by which texts refer to them. (licence, text); one licence may have many.
KNOWN = (
    ("MIT", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
     "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above "
     "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n" + _AS_IS),
    ("ISC", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
     "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_AS_IS),
    ("0BSD", "Zero-Clause BSD\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without "
     "fee is hereby granted.\n\n" + _ISC_AS_IS),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)


def normalised_lines(text: Column) -> Column:
    """Canonical lines of a text, without empty and copyright lines."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + PUNCTUATION, LOWER + " " * len(PUNCTUATION))

    def canonical(line: Column) -> Column:
        padded = F.concat(F.lit(" "), F.array_join(F.filter(F.split(line, " "), lambda w: w != ""), " "), F.lit(" "))
        return reduce(lambda y, p: F.replace(y, F.lit(f" {p[0]} "), F.lit(f" {p[1]} ")), SPELLINGS.items(), padded)

    def counts(line: Column) -> Column:
        owner = line.startswith(" copyright c ") | line.rlike("^ copyright [0-9©]") | line.startswith(" © ")
        return ~owner & ~line.startswith(" all rights reserved ") & (line != "  ")

    return F.transform(F.filter(F.transform(F.split(plain, "\n"), canonical), counts), lambda x: F.trim(x))


def catalogue(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(known, licence): digests of the known texts; of equal digests the first licence by name counts."""
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate(known)], "n int, licence string, text string")
    digest = F.md5(F.array_join(normalised_lines(F.col("text")), " "))
    return rows.select("licence", digest.alias("known")).groupBy("known").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known=KNOWN, text: str = "text") -> DataFrame:
    """One row per row: doc_id, digest and licence of the whole text, and the licences of its lines with their number."""
    table = stored(catalogue(docs.sparkSession, known))  # as many rows as known texts
    plain = docs.select("doc_id", F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_p"), normalised_lines(F.col(text)).alias("_lines"))
    cut = stored(
        plain.select(
            "doc_id", "_p", F.md5(F.array_join("_lines", " ")).alias("digest"),
            # only lines as long as some known text can be one
            F.transform(F.filter("_lines", lambda x: F.length(x) <= max(len(t) for _, t in known)), lambda x: F.md5(x)).alias("_digests"),
        )
    )
    small = F.broadcast(table)
    lines = cut.select("doc_id", "_p", F.explode("_digests").alias("known")).join(small, "known")
    per_doc = lines.groupBy("doc_id", "_p").agg(
        F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("notices"), F.count(F.lit(1)).alias("_n")
    )
    times = cut.groupBy("doc_id", "_p").agg(F.count(F.lit(1)).alias("_times"))
    found = per_doc.join(times, (per_doc.doc_id.eqNullSafe(times.doc_id)) & (per_doc["_p"] == times["_p"])).select(
        per_doc.doc_id.alias("_id"), per_doc["_p"].alias("_q"), "notices", F.expr("_n div _times").alias("n_notices")
    )
    whole = cut.join(small, cut.digest == F.col("known"), "left")
    both = whole.join(found, whole.doc_id.eqNullSafe(found["_id"]) & (whole["_p"] == found["_q"]), "left")
    return both.select(
        "doc_id", "digest", "licence", F.coalesce("notices", F.lit("")).alias("notices"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices")
    )


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents").select("doc_id", "text"))

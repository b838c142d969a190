"""License scans: canonical digests of whole texts and lines, joined to digests of known licences."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Known texts, as published. A notice is a text of one line.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_NAME = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN = [
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("BSD-2-Clause", BSD_HEAD + BSD_TAIL),
    ("BSD-3-Clause", BSD_HEAD + BSD_NAME + BSD_TAIL),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
]
# Equivalent spellings, word by word, after punctuation is gone.
SPELLINGS = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("sub license", "sublicense"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("non infringement", "noninfringement"),
    ("owner", "holder"),
    ("owners", "holders"),
    ("ver", "version"),
    ("v", "version"),
]
# A line that states a copyright, whole.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright[ \t]+(\(c\)|©|[0-9])|\(c\)[ \t]|©)[^\n]*$"
NOT_WORD = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, one space for punctuation and white space, one spelling per word."""
    column = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    column = F.concat(F.lit(" "), F.regexp_replace(column, NOT_WORD, " "), F.lit(" "))
    for other, usual in SPELLINGS:
        column = F.replace(column, F.lit(f" {other} "), F.lit(f" {usual} "))
    return F.regexp_replace(column, "^ +| +$", "")


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license_id), one row per digest. As long as the list of known texts."""
    rows = spark.createDataFrame(KNOWN if known is None else known, "license_id string, text string")
    return rows.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: list[tuple[str, str]] | None = None
) -> DataFrame:
    """One row per input row: id, text_digest, license_id, notices.

    The digest of the whole canonical text is hash-joined to the known digests: `license_id` is the
    licence that the text is, NULL if it is none. `notices` are the licences whose known text is a
    whole line of the text, sorted, comma-separated, empty if none. Nothing else of a text counts: a
    licence with other text around it in its line is not found. NULL texts are empty; an empty text is
    no licence; rows may repeat ids. The known list, a parameter, is part of the program, so its
    digests may be broadcast.
    """
    spark = docs.sparkSession
    table = known_digests(spark, known).filter(F.col("digest") != F.sha2(F.lit(""), 256))
    by_digest = F.broadcast(table.select(F.col("digest").alias("text_digest"), "license_id"))
    lookup = F.map_from_arrays(
        F.array(*[F.lit(d) for d, _ in sorted(map(tuple, table.collect()))]).cast("array<string>"),
        F.array(*[F.lit(i) for _, i in sorted(map(tuple, table.collect()))]).cast("array<string>"),
    )
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    lines = F.transform(F.split("_text", "\n"), lambda line: F.try_element_at(lookup, digest(line)))
    found = F.filter(lines, lambda license_id: license_id.isNotNull())
    marked = rows.select(
        "_id", digest(F.col("_text")).alias("text_digest"), F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("notices")
    )
    return marked.join(by_digest, "text_digest", "left").select(
        F.col("_id").alias(id_col), "text_digest", "license_id", "notices"
    )

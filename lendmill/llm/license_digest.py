"""Licence scan by canonical digests.

A text is brought into a canonical form (lower case, copyright lines dropped, punctuation and
white space as one blank, equivalent spellings replaced by one) and its digest is joined with the
digests of known licence texts. Whole documents and whole lines are looked up; nothing is matched
in part. Everything is built-in SQL functions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.session import materialize

# Equivalent spellings, each replaced by the second (whole words).
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"), ("per cent", "percent"), ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("non commercial", "noncommercial"), ("copyright holder", "copyright owner"),
    ("whilst", "while"), ("favour", "favor"), ("behaviour", "behavior"), ("https", "http"),
)

# Known licence texts and notices (public texts, without their copyright lines).
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_ZERO_BSD = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_APACHE_NOTICE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
)
KNOWN = (
    ("MIT", _MIT), ("MIT", "MIT License " + _MIT), ("MIT", "The MIT License (MIT) " + _MIT), ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC), ("ISC", "ISC License " + _ISC), ("ISC", "Licensed under the ISC License."), ("ISC", "SPDX-License-Identifier: ISC"),
    ("0BSD", _ZERO_BSD), ("0BSD", "SPDX-License-Identifier: 0BSD"),
    ("Apache-2.0", _APACHE_NOTICE), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"), ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
)
COPYRIGHT_LINE = r"(?m)^[^\n]*(copyright \(c\)|copyright ©|copyright [0-9]{4}|©|all rights reserved)[^\n]*$"
FIRST_WORD = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
SIGNS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_digest(rows: DataFrame, text: str) -> DataFrame:
    """`digest` of the canonical form; A-Z only are lower-cased, so that the form does not depend on a locale.

    Words are parted by two blanks until their spellings are settled, so that each has a blank of
    its own on both sides and neighbours are replaced alike. Copyright lines are looked for only where one of their words is.
    """
    lowered = rows.withColumn("_lowered", F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    marked = F.contains("_lowered", F.lit("copyright")) | F.contains("_lowered", F.lit("©")) | F.contains("_lowered", F.lit("all rights reserved"))
    out = F.when(marked, F.regexp_replace("_lowered", COPYRIGHT_LINE, " ")).otherwise(F.col("_lowered"))
    out = F.concat(F.lit("  "), F.regexp_replace(out, SIGNS, "  "), F.lit("  "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(_apart(old)), F.lit(_apart(new)))
    return lowered.withColumn("digest", F.sha2(F.trim(F.replace(out, F.lit("  "), F.lit(" "))), 256)).drop("_lowered")


def _apart(words: str) -> str:
    return f" {words.replace(' ', '  ')} "


def first_word(text: Column) -> Column:
    """The first word of a line's canonical form before equal spellings are replaced; only the line's start is read."""
    return F.translate(F.regexp_extract(text, FIRST_WORD, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def first_words(known=KNOWN) -> list[str]:
    """The words that a line equal to a known text may begin with, in any of the equivalent spellings."""
    found = {re.search(FIRST_WORD, text)[1].lower() for _, text in known}
    while True:
        more = found | {word.split()[0] for pair in SPELLINGS for word in pair if pair[0].split()[0] in found or pair[1].split()[0] in found}
        if more == found:
            return sorted(found)
        found = more


def known_digests(spark, known=KNOWN) -> DataFrame:
    """(digest, license_id): one row per distinct canonical text; the least id where two share it."""
    rows = spark.createDataFrame(list(known), "license_id string, text string")
    return with_digest(rows, "text").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known=KNOWN) -> DataFrame:
    """Per row: doc_id, text_digest, license_id (whole text), n_license_lines, line_licenses.

    `license_id` is null where the whole text is no known licence; `line_licenses` lists the
    distinct licences of whole lines, sorted and comma-joined (empty where none). Only lines that
    begin like a known text are brought into canonical form, which decides nothing by itself. A null or empty
    text has the digest of the empty form and no licence. Repeated rows repeat their result; ids
    may be null or repeat; other columns are ignored. The known texts are a constant of the code,
    so their table is bounded and broadcast.
    """
    digests = F.broadcast(known_digests(docs.sparkSession, known))
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    # the whole text is line 0; texts are read once
    lines = rows.select("id", F.xxhash64("text").alias("key"), F.posexplode(F.concat(F.array("text"), F.split("text", "\n", -1))).alias("line", "words"))
    some = lines.filter((F.col("line") == 0) | first_word(F.col("words")).isin(first_words(known)))
    found = with_digest(some, "words").drop("words").join(digests, "digest", "left")
    found = materialize(found.filter((F.col("line") == 0) | F.col("license_id").isNotNull()), "license-lines")
    # a row that repeats has the same lines at the same places
    per_text = found.filter("line > 0").groupBy(F.col("id").alias("of"), F.col("key").alias("of_key")).agg(
        F.count_distinct("line").alias("n"), F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("found")
    )
    whole = found.filter("line = 0")
    out = whole.join(per_text, whole["id"].eqNullSafe(per_text["of"]) & (whole["key"] == per_text["of_key"]), "left")
    return out.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("text_digest"), "license_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_license_lines"), F.coalesce("found", F.lit("")).alias("line_licenses")
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_digest(text: str) -> str:
    out = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = f"regexp_replace({out}, {_quoted(COPYRIGHT_LINE)}, ' ', 'g')"
    out = f"concat('  ', regexp_replace({out}, {_quoted(SIGNS)}, '  ', 'g'), '  ')"
    for old, new in SPELLINGS:
        out = f"replace({out}, '{_apart(old)}', '{_apart(new)}')"
    return f"sha256(trim(replace({out}, '  ', ' ')))"


def check_sql() -> str:
    """The same scan as one SQL statement over `documents`."""
    values = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN)
    return f"""
    WITH known AS (SELECT {_sql_digest('text')} AS digest, min(license_id) AS license_id FROM (VALUES {values}) AS v(license_id, text) GROUP BY 1),
    rows AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM rows),
    matched AS (SELECT doc_id, license_id FROM lines JOIN known ON {_sql_digest('line')} = digest),
    per_doc AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS found FROM matched GROUP BY doc_id)
    SELECT r.doc_id, {_sql_digest('r.text')} AS text_digest, k.license_id, coalesce(p.n, 0)::BIGINT AS n_license_lines, coalesce(p.found, '') AS line_licenses
    FROM rows r LEFT JOIN known k ON {_sql_digest('r.text')} = k.digest LEFT JOIN per_doc p ON r.doc_id = p.doc_id
    """

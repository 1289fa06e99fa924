"""Licence texts found by canonical digest.

A text is brought to a canonical form and hashed; a hash join with the digests of
known licences names it. The form ignores case, copyright lines, punctuation,
white space and spellings that mean the same, as licence matching guidelines ask.
Besides the whole text, each of its lines is looked up as an entire text, which
finds one-line notices above other content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words that count as the same (the first becomes the second).
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("non infringement", "noninfringement"), ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"), ("favour", "favor"), ("organisation", "organization"),
    ("whilst", "while"), ("wilful", "willful"), ("merchantable quality", "merchantability"), ("http", "https"),
)

# Known texts: short notices and the short licences in full.
KNOWN = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC0-1.0 notice": "Licensed under CC0 1.0 Universal.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT": """MIT License

Copyright (c) <year> <holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License

Copyright (c) <year> <holders>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
}

COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(?:copyright\b|\(c\)|©)[^\n]*(?:[0-9]{4}|<|\(c\)|©|all rights)[^\n]*$"


def canonical(text: Column) -> Column:
    """The form that is hashed: words with single blanks between."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    out = F.regexp_replace(out, r"[^a-z0-9\x{80}-\x{10FFFF}]+", " ")
    out = F.concat(F.lit(" "), F.trim(out), F.lit(" "))
    for old, new in SPELLINGS:
        for _ in range(2):  # neighbours share a blank
            out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(out)


def digest(text: Column) -> Column:
    """Null for a null text or one without words."""
    form = canonical(text)
    return F.when(form != "", F.md5(form))


def known_licenses(spark: SparkSession, texts: dict[str, str] = KNOWN) -> DataFrame:
    """(license, known_digest): each digest once, under its first name."""
    rows = [F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in texts.items()]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    return table.groupBy(digest(F.col("text")).alias("known_digest")).agg(F.min("license").alias("license"))


def scanned(docs: DataFrame, texts: dict[str, str] = KNOWN) -> DataFrame:
    """(doc_id, digest, license, notices) of each row of ``docs(doc_id, text)``.

    ``license`` is that of the entire text, else null; ``notices`` names those of
    its lines, each once, in order. Null and wordless texts have no digest and
    name nothing; repeated rows are repeated. The known texts are the caller's
    own list, so their digests fit in every task.
    """
    table = known_licenses(docs.sparkSession, texts) if texts else None
    names = {r.known_digest: r.license for r in table.collect()} if texts else {}
    text = F.col("text").cast("string")
    line = F.transform(F.split(text, "\n"), digest)
    rows = docs.select("doc_id", digest(text).alias("digest"), line.alias("lines"))
    lookup = F.create_map(*[F.lit(x) for k in sorted(names) for x in (k, names[k])]) if names else None
    found = F.transform("lines", lambda d: lookup[d]) if names else F.array().cast("array<string>")
    notices = F.coalesce(F.array_sort(F.array_distinct(F.filter(found, lambda n: n.isNotNull()))), F.array().cast("array<string>"))
    if names:
        out = rows.join(F.broadcast(table), F.col("digest") == F.col("known_digest"), "left")
    else:
        out = rows.withColumn("license", F.lit(None).cast("string"))
    return out.select("doc_id", "digest", "license", notices.alias("notices"))


def _sql() -> str:
    def canon(text: str) -> str:
        out = rf"regexp_replace(lower({text}), '{COPYRIGHT_LINE.replace('(?m)', '')}', ' ', 'gm')"
        out = rf"trim(regexp_replace({out}, '[^a-z0-9\x{{80}}-\x{{10FFFF}}]+', ' ', 'g'), ' ')"
        out = f"' ' || {out} || ' '"
        for old, new in SPELLINGS:
            out = f"replace(replace({out}, ' {old} ', ' {new} '), ' {old} ', ' {new} ')"
        return f"trim({out}, ' ')"

    def sha(text: str) -> str:
        return f"md5(nullif({canon(text)}, ''))"

    known = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in KNOWN.items())
    return f"""WITH known AS (SELECT {sha('t')} AS d, min(n) AS license FROM (VALUES {known}) AS v(n, t) GROUP BY 1),
rows AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
whole AS (SELECT r, doc_id, {sha('text')} AS digest FROM rows),
found AS (
  SELECT r, list_sort(list(DISTINCT license)) AS notices
  FROM (SELECT r, {sha('line')} AS d FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM rows)) JOIN known USING (d)
  GROUP BY r)
SELECT doc_id, digest, license, coalesce(notices, []) AS notices
FROM whole LEFT JOIN known ON d = digest LEFT JOIN found USING (r)"""


SQL = _sql()

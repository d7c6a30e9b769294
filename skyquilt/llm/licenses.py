"""Licence scan by canonical digests, in DataFrame expressions.

A text is made canonical line by line: lower case, punctuation to spaces, equivalent spellings to one, copyright lines gone. The
digests of a document's whole text, of each of its paragraphs (lines between blank ones) and of each of its lines are
looked up, as entire texts, in the digests of the known licences and notices by a hash join. The catalogue is a table; the one below
is the default, with the digests of the common licences' whole texts and headers (``license_digests``). It is broadcast where it has ``broadcast_rows`` rows at most (checked), else joined by a shuffle.

A known text that is cut by blank lines is found as a run of paragraphs, however it is cut and wrapped: where a paragraph begins
with the ``OPENING`` first characters of a known text, the runs from there that end with a paragraph and are as long as a known text are
looked up too (unit ``run``). Equivalent spellings are applied to a run as a whole. A run that equals the whole text or a
paragraph as listed isn't listed again.

Defined cases: a null text is empty and matches nothing; a unit that is empty once canonical matches nothing; a document of one line is
found as a whole text, a paragraph and a line; equal ids and repeated rows are reported each; an empty table gives no
rows; columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.llm.common import let, materialize, table
from skyquilt.llm.license_digests import WHOLE

#: Characters at the start of a known text by which runs are begun.
OPENING = 16

#: Spellings that mean the same in a licence; the second is kept. Canonical words, spaces around.
EQUIVALENT = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("https", "http"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
    ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("per cent", "percent"),
    ("v2", "version 2"),
    ("v3", "version 3"),
]

#: Fixed value: a canonical line that states a copyright and nothing else.
COPYRIGHT_LINE = "^((copyright|c) (c )?(.* )?([0-9]{4}|year|yyyy)( .*)?|all rights reserved)$"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
"""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_0BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
"""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
#: Fixed values, public texts: licence, and its text or a notice of it.
CATALOGUE = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("ISC", _ISC + _AS_IS),
    ("ISC", "ISC License\n" + _ISC + _AS_IS),
    ("0BSD", _0BSD + _AS_IS),
    ("Zlib", _ZLIB),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
]


def canonical_line(line: Column) -> Column:
    return same_spelling(F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " ")))


def same_spelling(words: Column) -> Column:
    out = F.concat(F.lit(" "), words, F.lit(" "))
    for a, b in EQUIVALENT:
        out = F.replace(out, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(out)


def units(text: Column, starts: dict[str, list[int]] | None = None) -> Column:
    """Canonical units of a text: ``unit`` (text, paragraph, line, run), ``line`` (number of its first, from 1) and ``canonical``.

    ``starts``: the openings of the texts that runs may be, and the lengths in characters of those with that opening.
    """
    unit = lambda kind, at, canonical: F.struct(F.lit(kind).alias("unit"), at.cast("int").alias("line"), canonical.alias("canonical"))
    stays = lambda x: (x != "") & ~x.rlike(COPYRIGHT_LINE)
    join = lambda lines: F.array_join(F.filter(lines, stays), " ")

    def of(lines: Column) -> Column:
        ends = F.filter(F.transform(lines, lambda x, i: F.when(x == "", i + 1)), lambda i: i.isNotNull())
        blanks = F.concat(F.array(F.lit(0)), ends, F.array(F.size(lines) + 1))
        paragraphs = let(
            blanks,
            lambda b: F.transform(
                F.slice(b, 2, F.size(b) - 1), lambda e, k: unit("paragraph", F.get(b, k) + 1, join(F.slice(lines, F.get(b, k) + 1, e - F.get(b, k) - 1)))
            ),
        )
        single = F.transform(lines, lambda x, i: unit("line", i + 1, F.when(stays(x), x).otherwise("")))
        found = F.filter(F.concat(F.array(unit("text", F.lit(1), join(lines))), paragraphs, single), lambda u: u["canonical"] != "")
        return let(found, lambda f: F.concat(f, runs(F.filter(f, lambda u: u["unit"] == "paragraph"), F.get(f, F.lit(0))["canonical"]))) if starts else found

    def runs(paragraphs: Column, whole: Column) -> Column:
        opening = lambda x: F.substring(x, 1, OPENING)
        near = lambda i: same_spelling(F.array_join(F.transform(F.slice(paragraphs, i + 1, OPENING), lambda u: u["canonical"]), " "))
        firsts = sorted({k.split(" ")[0] for k in starts})
        places = F.transform(paragraphs, lambda u, i: F.when(F.substring_index(same_spelling(F.substring_index(u["canonical"], " ", 3)), " ", 1).isin(firsts) & opening(near(i)).isin(list(starts)), i))
        # from there to the end, paragraphs apart by a line feed
        rest = lambda i: F.array_join(F.transform(F.slice(paragraphs, i + 1, F.size(paragraphs)), lambda u: same_spelling(u["canonical"])), "\n")
        lengths = lambda x: F.coalesce(*[F.when(x == k, F.array(*[F.lit(n) for n in v])) for k, v in sorted(starts.items())])
        one = lambda i: let(
            F.struct(F.concat(rest(i), F.lit("\n")).alias("r"), F.get(paragraphs, i)["line"].alias("line"), F.get(paragraphs, i)["canonical"].alias("first")),
            lambda s: F.filter(
                F.transform(
                    F.filter(lengths(opening(F.translate(s["r"], "\n", " "))), lambda n: F.substring(s["r"], n + 1, F.lit(1)) == "\n"),
                    lambda n: unit("run", s["line"], F.translate(F.substring(s["r"], F.lit(1), n), "\n", " ")),
                ),
                lambda u: (u["canonical"] != whole) & (u["canonical"] != s["first"]),
            ),
        )
        return F.flatten(F.transform(F.filter(places, lambda i: i.isNotNull()), lambda i: F.coalesce(one(i), F.filter(paragraphs, lambda u: F.lit(False)))))

    return let(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), canonical_line), of)


def catalogue(spark: SparkSession, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    """``license_id`` and ``digest`` of the known texts, and the ``opening`` and length in characters (``chars``) by which runs are found.

    Of given texts, or by default of those here and in ``license_digests``.
    """
    given = spark.createDataFrame(CATALOGUE if rows is None else rows, "license_id string, text string")
    whole = F.get(F.filter(units(F.col("text")), lambda u: u["unit"] == "text"), F.lit(0))["canonical"]
    both = F.explode(F.array_distinct(F.array(whole, same_spelling(whole)))).alias("canonical")
    texts = given.select("license_id", both).where("canonical IS NOT NULL")
    texts = texts.select("license_id", F.sha2("canonical", 256).alias("digest"), F.substring("canonical", 1, OPENING).alias("opening"), F.length("canonical").alias("chars"))
    if rows is None:
        texts = texts.unionByName(spark.createDataFrame(WHOLE, "license_id string, digest string, opening string, chars int"))
    return texts.distinct()


def scan(df: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 100_000) -> DataFrame:
    """A row for each unit that is a known text: ``doc_id unit line license_id digest``.

    ``known``: as from ``catalogue``; without ``opening`` and ``chars`` no runs are looked up. Openings and lengths go through the driver.
    """
    known = materialize(known, "licenses")
    small = known.count() <= broadcast_rows
    starts: dict[str, list[int]] = {}
    if {"opening", "chars"} <= set(known.columns):
        for r in known.select("opening", "chars").distinct().collect():
            starts.setdefault(r["opening"], []).append(r["chars"])
    known = known.select("license_id", "digest").distinct()
    found = df.select(F.col(id_col).alias("doc_id"), F.explode(units(F.col(text_col), starts)).alias("u")).select(
        "doc_id", "u.unit", "u.line", F.sha2("u.canonical", 256).alias("digest")
    )
    return found.join(F.broadcast(known) if small else known, "digest").select("doc_id", "unit", "line", "license_id", "digest")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), catalogue(spark))


def _canonical_sql(line: str) -> str:
    out = f"(' ' || trim(regexp_replace(lower({line}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' ')"
    for a, b in EQUIVALENT:
        out = f"replace({out}, ' {a} ', ' {b} ')"
    return f"trim({out})"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


OP7_SQL = f"""
WITH known AS (SELECT column0 AS license_id, column1 AS text FROM (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in CATALOGUE)}) AS v(column0, column1)),
src AS (
  SELECT row_number() OVER () AS rid, doc_id, NULL AS license_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, license_id, text FROM known
),
cut AS (SELECT rid, doc_id, license_id, unnest(string_split(text, chr(10))) AS y, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM src),
canon AS (SELECT rid, doc_id, license_id, i, {_canonical_sql("y")} AS x FROM cut),
lines AS (
  SELECT *, x <> '' AND NOT regexp_matches(x, '{COPYRIGHT_LINE}') AS keep,
         count(*) FILTER (WHERE x = '') OVER (PARTITION BY rid ORDER BY i) AS p,
         coalesce(max(CASE WHEN x = '' THEN i END) OVER (PARTITION BY rid ORDER BY i), 0) + 1 AS first
  FROM canon
),
u AS (
  SELECT rid, doc_id, license_id, 'text' AS unit, 1 AS line, string_agg(x, ' ' ORDER BY i) FILTER (WHERE keep) AS canonical FROM lines GROUP BY rid, doc_id, license_id
  UNION ALL
  SELECT rid, doc_id, license_id, 'paragraph', first, string_agg(x, ' ' ORDER BY i) FILTER (WHERE keep) FROM lines GROUP BY rid, doc_id, license_id, p, first
  UNION ALL
  SELECT rid, doc_id, license_id, 'line', i, x FROM lines WHERE keep
),
k AS (SELECT DISTINCT license_id, sha256(canonical) AS digest FROM u WHERE rid < 0 AND unit = 'text' AND canonical IS NOT NULL)
SELECT u.doc_id, u.unit, u.line::INTEGER AS line, k.license_id, k.digest FROM u JOIN k ON sha256(u.canonical) = k.digest WHERE u.rid > 0
"""

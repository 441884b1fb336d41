"""Licence scans: canonical digests of entire texts and lines, joined to digests of known licences."""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.joins import join_short

#: Equivalent spellings, fixed values: after lower-casing the first is written as the second.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("copyright owner", "copyright holder"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"),
    ("maximise", "maximize"), ("modelled", "modeled"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"),
    ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("https://", "http://"), ("&", "and"),
)

#: What follows "copyright" and "(c)" in running text of licences; any other word is a holder.
NO_HOLDERS = (
    "and", "are", "disclaimer", "doctrines", "header", "headers", "holder", "holders", "if", "in", "information",
    "infringement", "interest", "interests", "is", "law", "laws", "licence", "license", "licenses", "line", "notice",
    "notices", "of", "on", "or", "owner", "owners", "ownership", "permission", "permissions", "protection", "resulting",
    "rights", "statement", "statements", "the library", "the program", "the software", "the work", "to", "treaty",
)
NO_HOLDERS_AFTER_SIGN = ("representations", "the licenses", "under", "you")


def _other_words(phrases: tuple[str, ...]) -> str:
    """A pattern, without lookahead, of words in lower case that begin with none of the phrases as whole words."""
    def of(rest: tuple[str, ...], within: bool) -> str:
        first = sorted({phrase[0] for phrase in rest if phrase})
        letters = "".join(x for x in first if x != " ")
        ways = [rf"[^{letters}\P{{L}}]"] + [
            ("[ \\t]+" if x == " " else x) + of(tuple(p[1:] for p in rest if p[:1] == x), x != " ") for x in first]
        if within and "" not in rest and " " not in first:
            ways.append(r"[^\p{L}\n]|$")
        return f"(?:{'|'.join(ways)})"

    return of(phrases, False)


#: A line that names a copyright holder or reserves rights, in lower case.
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}\n©]*(?:copyright[^\p{L}\n]*(?:\(c\)|©|[0-9])|copyright[ \t:]*[\[<{]|copyright[ \t:]+"
    + _other_words(NO_HOLDERS) + r"|\(c\)[ \t]*(?:[^\p{L} \t\n]|$|" + _other_words(NO_HOLDERS_AFTER_SIGN)
    + r")|©|all rights reserved)[^\n]*$"
)

#: Known notices of one line, by licence, as they stand in sources and documents.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
)

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT \
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT \
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF \
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN \
THE SOFTWARE."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS \
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR \
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR \
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH \
THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee \
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

""" + _ISC_WARRANTY
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided \
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following \
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following \
disclaimer in the documentation and/or other materials provided with the distribution.

"""
_BSD_NAMES = """3. Neither the name of the {} nor the names of its contributors may be used to endorse or promote products \
derived from this software without specific prior written permission.

"""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE {0} AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, \
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE \
DISCLAIMED. IN NO EVENT SHALL THE {1} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, \
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF \
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, \
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN \
IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_HOLDERS = _BSD_WARRANTY.format("COPYRIGHT HOLDERS", "COPYRIGHT HOLDER")
_BSD_REGENTS = _BSD_WARRANTY.format("REGENTS", "REGENTS")

#: Where the terms of a text end; its appendix often stays away.
_END = "END OF TERMS AND CONDITIONS"


def _packaged() -> list[tuple[str, str]]:
    """(licence, text) of the files in ``known``, with and without an appendix."""
    out = []
    for file in sorted(resources.files("tidepool.llm").joinpath("known").iterdir(), key=lambda x: x.name):
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        out.append((name, text))
        if _END in text:
            terms = text[:text.index(_END)]
            out += [(name, terms), (name, terms + _END)]
    return out


#: Known licence texts; their copyright lines don't count.
TEXTS = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and \
associated documentation files (the "Software"), to deal in the Software without restriction, including without \
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the \
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the \
Software.

""" + _WARRANTY),
    ("ISC", _ISC),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee \
is hereby granted.

""" + _ISC_WARRANTY),
    ("ISC", "ISC License\n\n" + _ISC),
    ("BSD-2-Clause", _BSD + _BSD_HOLDERS),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD + _BSD_HOLDERS),
    ("BSD-3-Clause", _BSD + _BSD_NAMES.format("copyright holder") + _BSD_HOLDERS),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD + _BSD_NAMES.format("copyright holder") + _BSD_HOLDERS),
    ("BSD-3-Clause", _BSD + _BSD_NAMES.format("University") + _BSD_REGENTS),
    *_packaged(),
)


def known_licences(spark: SparkSession) -> DataFrame:
    """(licence_id, text) of the licences and notices above."""
    rows = [*TEXTS, *(("MIT", "MIT License\n\n" + text) for name, text in TEXTS if name == "MIT"), *NOTICES]
    return spark.createDataFrame(rows, "licence_id string, text string")


def canonical_lines(text: Column) -> Column:
    """Lower case, copyright lines emptied, spellings made one, a space for all that is not a
    letter, digit or line end. NULL counts as empty."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    return F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")


def joined(lines: Column) -> Column:
    """Canonical lines as one text."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def digests(known: DataFrame, licence_col: str = "licence_id", text_col: str = "text") -> DataFrame:
    """(digest, licence_id): one row for each canonical text; the first licence by name if several
    have it. Empty texts and NULL licences are left out."""
    rows = known.select(F.col(licence_col).alias("licence_id"), joined(canonical_lines(F.col(text_col))).alias("body"))
    return (rows.where("body <> '' and licence_id is not null").groupBy(F.md5("body").alias("digest"))
            .agg(F.min("licence_id").alias("licence_id")))


def licences(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, scope, licence_id, digest, found) for each document with a known licence.

    Scope 'text': the canonical text of the whole document is a known one. Scope 'line': so
    many of its lines are, each taken as a whole text. Only digests are joined, never texts,
    and documents without a hit drop out in that join: the known digests are counted and go to
    every task, or, if they are very many, meet a salted shuffle. Empty and NULL texts match nothing.
    Hits are added up by id, so documents that repeat an id, or have none, share their rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), canonical_lines(F.col(text_col)).alias("lines"))
    unit = F.struct(F.lit("text").alias("scope"), joined(F.col("lines")).alias("body"))
    lines = F.transform(F.split("lines", "\n"), lambda line: F.struct(F.lit("line").alias("scope"), F.trim(line).alias("body")))
    units = (rows.select("id", F.explode(F.concat(F.array(unit), lines)).alias("unit"))
             .where("unit.body <> ''").select("id", "unit.scope", F.md5("unit.body").alias("digest")))
    return (join_short(units, digests(known), ["digest"])
            .groupBy("id", "scope", "licence_id", "digest").agg(F.count("*").alias("found")))

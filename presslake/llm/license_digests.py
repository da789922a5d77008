"""Licence texts by the digest of their canonical form, without Python.

Case, punctuation, copyright lines and equivalent spellings are normalised, and
the SHA-256 of the whole canonical text is joined with the digests of known
texts. Two texts match exactly if their canonical forms are equal.
"""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_LICENCES = 100_000  # digests up to this number are broadcast: some 10 MB
SALTS = 32

# Lines left out, as (pattern, replacement) on lower-cased text.
COPYRIGHT_LINE = r"(^|\n)[^\S\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*"

# Spellings that count as equal, applied to blank-separated words.
EQUIVALENT_WORDS = {
    "acknowledgement": "acknowledgment",
    "analog": "analogue",
    "analyze": "analyse",
    "artifact": "artefact",
    "authorization": "authorisation",
    "authorized": "authorised",
    "caliber": "calibre",
    "canceled": "cancelled",
    "capitalizations": "capitalisations",
    "catalog": "catalogue",
    "categorize": "categorise",
    "center": "centre",
    "customize": "customise",
    "emphasized": "emphasised",
    "favor": "favour",
    "favorite": "favourite",
    "fulfill": "fulfil",
    "fulfillment": "fulfilment",
    "https": "http",
    "initialize": "initialise",
    "judgement": "judgment",
    "labeling": "labelling",
    "labor": "labour",
    "licence": "license",
    "licenced": "licensed",
    "maximize": "maximise",
    "modeled": "modelled",
    "modeling": "modelling",
    "noncommercial": "non commercial",
    "offense": "offence",
    "optimize": "optimise",
    "organization": "organisation",
    "organize": "organise",
    "percent": "per cent",
    "practice": "practise",
    "program": "programme",
    "realize": "realise",
    "recognize": "recognise",
    "signaling": "signalling",
    "sublicence": "sublicense",
    "utilization": "utilisation",
    "while": "whilst",
    "willfull": "wilful",
    "wishfull": "wishful",
}

# Known texts, by public identifier.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZERO_BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_CLAUSES = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
)
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _bsd(clauses: int) -> list[str]:
    """The licence with its clauses numbered and not, with and without a title."""
    some = _BSD_CLAUSES[:clauses]
    bodies = [
        "\n\n".join([_BSD_HEAD, *listed, _BSD_TAIL])
        for listed in ([f"{i}. {text}" for i, text in enumerate(some, 1)], [f"* {text}" for text in some])
    ]
    return [title + body for body in bodies for title in ("", f"BSD {clauses}-Clause License\n\n")]


KNOWN_LICENCES = {
    "MIT": ["The MIT License (MIT)\n\n" + _MIT, "MIT License\n\n" + _MIT, _MIT],
    "ISC": ["ISC License\n\n" + _ISC, _ISC],
    "0BSD": ["BSD Zero Clause License\n\n" + _ZERO_BSD, _ZERO_BSD],
    "Apache-2.0-notice": ["Licensed under the Apache License, Version 2.0."],
    "CC-BY-NC-4.0-notice": ["Licensed under CC BY-NC 4.0."],
    "GPL-3.0-notice": ["This work is licensed under the GNU General Public License, version 3."],
    "MIT-notice": ["Released under the MIT License."],
    "BSD-2-Clause": _bsd(2),
    "BSD-3-Clause": _bsd(3),
}
# Whole texts, a file each.
for _file in sorted((Path(__file__).parent / "licences").glob("*.txt")):
    KNOWN_LICENCES[_file.stem] = [_file.read_text(encoding="utf-8")]


def canonical(text: Column) -> Column:
    """The canonical form of a text; null stays null.

    Lower case; lines that open with a copyright notice left out; whatever is
    neither letter nor digit becomes a blank, runs of them one; words of
    equivalent spelling take one form.
    """
    lower = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "\n")
    words = F.split(F.trim(F.regexp_replace(lower, r"[^\p{L}\p{N}]+", " ")), " ")
    table = F.create_map(*[F.lit(x) for pair in EQUIVALENT_WORDS.items() for x in pair])
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.element_at(table, w), w)), " ")


def known_digests(spark: SparkSession, licences: Mapping[str, list[str]] | None = None) -> DataFrame:
    """A row per known canonical text: ``digest`` and ``licence``, the smallest
    name if several have one text."""
    texts = KNOWN_LICENCES if licences is None else licences
    rows = [(name, text) for name, some in texts.items() for text in some]
    table = spark.createDataFrame(rows, "licence string, text string")
    found = table.select("licence", canonical(F.col("text")).alias("canonical"))
    return (
        found.filter("canonical <> ''")
        .groupBy(F.sha2("canonical", 256).alias("digest"))
        .agg(F.min("licence").alias("licence"))
    )


def match_licences(
    documents: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``digest`` of its canonical text, ``licence``.

    ``known`` has ``digest`` and ``licence``. ``licence`` is null where the whole
    text is none of the known ones. A null text has a null digest; an empty one,
    or one of punctuation alone, has the digest of the empty text and never
    matches. Repeated rows are matched one by one. Only id and text are read.
    """
    rows = documents.select(F.col(id_col), F.sha2(canonical(F.col(text_col)), 256).alias("digest"))
    side = known.select("digest", "licence").dropDuplicates(["digest"])
    if side.count() <= BROADCAST_LICENCES:
        return rows.join(F.broadcast(side), "digest", "left").select(id_col, "digest", "licence")
    # Copies of one text may be a third of all rows: deal them over the salts.
    salted = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["digest", "salt"], "left").select(id_col, "digest", "licence")

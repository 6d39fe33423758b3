"""License scans by canonical digest lookup.

A text is brought to a canonical form (case, punctuation, copyright lines, equivalent
spellings, white space) and digested; the digest is looked up among those of known licence
texts. Digests are of entire units: the whole document, and each of its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small

# Notices and licence texts as published.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_REDISTRIBUTION = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_AS_IS = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD2 = _REDISTRIBUTION + _AS_IS
BSD3 = _REDISTRIBUTION + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
""" + _AS_IS
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL3_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
KNOWN = [
    ("MIT", MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", ISC),
    ("BSD-2-Clause", BSD2),
    ("BSD-3-Clause", BSD3),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-or-later", GPL3_NOTICE),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
]
# Canonical length and SHA-256 of published texts too long to stand here: whole files, up to and before
# "END OF TERMS AND CONDITIONS", and terms without the notices to copy that follow them. A test makes them anew from the texts.
DIGESTS: list[tuple[str, int, str]] = [
    ("Apache-2.0", 9889, "45c5565dedc03ff2a570c67c5af611f8a3d0a0227c6e81d9fb11fbf0c004b959"),  # whole
    ("Apache-2.0", 8872, "6530dac82be99e5bbcc128a6caf5bfdd0451a21fe23ac3df15ed85a1c550c859"),  # to end
    ("Apache-2.0", 8844, "2b4a3f34572f63637f58db72bdacad38516a1e1e6788b08931d0a0d5c0be33dd"),  # before end
    ("GPL-2.0-only", 17117, "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),  # whole
    ("GPL-2.0-only", 14483, "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),  # to end
    ("GPL-2.0-only", 14455, "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),  # before end
    ("GPL-3.0-only", 33409, "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),  # whole
    ("GPL-3.0-only", 30968, "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),  # to end
    ("GPL-3.0-only", 30940, "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),  # before end
    ("GPL-1.0-only", 11765, "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),  # whole
    ("GPL-1.0-only", 9415, "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),  # to end
    ("GPL-1.0-only", 9387, "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),  # before end
    ("LGPL-2.0-only", 24130, "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),  # whole
    ("LGPL-2.0-only", 22277, "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),  # to end
    ("LGPL-2.0-only", 22249, "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),  # before end
    ("LGPL-2.1-only", 25217, "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),  # whole
    ("LGPL-2.1-only", 23365, "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),  # to end
    ("LGPL-2.1-only", 23337, "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),  # before end
    ("LGPL-3.0-only", 7104, "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),  # whole
    ("MPL-1.1", 22468, "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),  # whole
    ("MPL-2.0", 14353, "9672a697b80e59f5b1b0201e64d65dee8762b193cdd934dc5bcf2b57350a2ead"),  # whole
    ("MPL-2.0", 13661, "075fcdf87448c49dbad8c5f7963f0eb6907a3d8eae1b431ba2988508499ec0de"),  # terms
    ("CC0-1.0", 6692, "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),  # whole
    ("Artistic-1.0-Perl", 5833, "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),  # whole
    ("GFDL-1.2-only", 19584, "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),  # whole
    ("GFDL-1.2-only", 18387, "8d636e2e2f248f9b102e9d9f78337901ec8bca3bfe91434cdcf261a01bf305b1"),  # terms
    ("GFDL-1.3-only", 22066, "4c3aa0e0802ac2b46ef7e43be4900a68b957cef6e2e894bd3e06248976da6e07"),  # whole
    ("GFDL-1.3-only", 20869, "6e634dea02bafd9723c71af4d43d912bcd3755e0e915e6de5bde209f71adaaf3"),  # terms
]
#: Lengths of known texts by which lines are chosen.
LENGTHS = 1_000
#: Equivalent spellings of whole words of the canonical form.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "merchantibility": "merchantability",
    "organisation": "organization", "authorised": "authorized", "authorisation": "authorization", "recognised": "recognized", "acknowledgement": "acknowledgment",
    "favour": "favor", "honour": "honor", "whilst": "while", "v2": "version 2", "v3": "version 3",
}
#: Equivalent phrases, after the words and in this order.
PHRASES = {
    "sub license": "sublicense", "sub licensed": "sublicensed", "non commercial": "noncommercial", "v 2": "version 2", "v 3": "version 3", "copyright owner": "copyright holder",
    "copyright owners": "copyright holders", "per cent": "percent", "cc by": "creative commons attribution", "http www": "https www",
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: How a licence begins that follows its notice on the same line.
BEGINS = r"permission (?:is hereby granted|to use)|licen[sc]ed under|released under|spdx-|redistribution and use|the software is provided|this (?:program|work|software|library|file) is"
#: Words after "copyright" at the beginning of a wrapped line of a licence's sentence, where no holder is named.
NO_HOLDER = r"notices?|holders?|owners?|laws?|licen[sc]es?|licen[sc]ed|statements?|disclaimers?|interests?|protection|acts?|treat(?:y|ies)|and|or|in|on|is|to|for|of|as|with|shall|may|must|claims?|status|information|infringement|rights?|permission|material|works?|patents?|trademarks?"
#: A notice of who holds the copyright (a sign or a year follows the word, or a name the capitalised word), up to its line's end or the licence.
NOTICE = (
    r"(?m)^[^A-Za-z0-9\n(©]*(?:(?i:copyright)[ \t:,]*(?:\((?i:c)\)|©|(?:19|20)[0-9]{2})|C(?:opyright|OPYRIGHT)[ \t:,]+(?!(?i:" + NO_HOLDER + r")(?![A-Za-z0-9]))(?=[^\n]*[A-Za-z0-9\x{80}-\x{10FFFF}])"
    r"|\((?i:c)\)[ \t]*(?=(?:19|20)[0-9]{2})|©)[^\n]*?(?=$|(?i:" + BEGINS + "))"
)
#: A notice's second line.
RESERVED = r"(?mi)^[^A-Za-z0-9\n]*all[ \t]+rights[ \t]+reserved[^A-Za-z0-9\n]*$"
#: The registered SQL's expression, which takes every line that begins with the word; they agree where all such lines are notices.
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(?:(?:copyright|\(c\)|©)[^\n]*|all[ \t]+rights[ \t]+reserved[^a-z0-9\n]*)$"
#: In canonical texts with this word: numbers of conditions go, and who is named in the third one and in the disclaimer is the holder.
SLOTS_IN = "redistributions"
SLOTS = [
    (r"(^| )[0-9a-z] (redistributions (?:of|in) |neither the name of )", r"\1\2"),
    (r"neither the name of (?:[^ ]+ ){1,12}?nor the names of its contributors", "neither the name of the copyright holder nor the names of its contributors"),
    (r"is provided by (?:[^ ]+ ){1,12}?and contributors as is", "is provided by the copyright holders and contributors as is"),
    (r"in no event shall (?:[^ ]+ ){1,12}?or contributors be liable", "in no event shall the copyright holder or contributors be liable"),
]
#: A title above a licence whose text doesn't have it.
TITLE = r"^(?:the )?(?:mit|isc|expat|bsd|bsd 2 clause|bsd 3 clause|new bsd|simplified bsd|modified bsd)(?: (?:simplified|new|revised|or|mit|x11))* license(?: (?:mit|isc|expat|x11|bsd))? (?=permission |redistribution )"
#: What the canonical form keeps; all else but the ends of lines is a space.
KEPT = r"a-z0-9\x{80}-\x{10FFFF}"


def _replaced(text: Column, words: dict[str, str]) -> Column:
    """Words or phrases in their canonical spelling."""
    out = text
    for a, b in words.items():
        out = F.replace(out, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
    return out


def _lines(text: Column) -> Column:
    """The words of each line in their canonical spelling, with a space on either side of each, so that neighbours share none."""
    ascii_only = F.length(text) == F.octet_length(text)
    small = F.lower(text)
    out = F.when(small.contains("copyright") | small.contains("(c)") | text.contains("©"), F.regexp_replace(text, NOTICE, "")).otherwise(text)
    out = F.when(small.contains("reserved"), F.regexp_replace(out, RESERVED, "")).otherwise(out)
    out = F.when(ascii_only, F.lower(out)).otherwise(F.translate(out, _UPPER, _LOWER))  # the same letters, faster
    out = F.concat(F.lit(" "), F.regexp_replace(out, rf"[^{KEPT}\n]+", "  "), F.lit(" "))
    out = F.replace(out, F.lit("\n"), F.lit(" \n "))
    return _replaced(_replaced(out, SPELLINGS), PHRASES)


def _plain(words: Column) -> Column:
    """Words one space apart, conditions and holders in their canonical form."""
    out = F.replace(F.trim(words), F.lit("  "), F.lit(" "))
    filled = out
    for found, to in SLOTS:
        filled = F.regexp_replace(filled, found, to.replace("\\", "$"))
    return F.when(out.contains(SLOTS_IN), filled).otherwise(out)


def _whole(lines: Column) -> Column:
    """The canonical form of the whole text; phrases may go on in the next line."""
    out = _plain(_replaced(F.regexp_replace(lines, r" *\n[ \n]*", "  "), PHRASES))
    return F.regexp_replace(out, TITLE, "")


def canonical(text: Column) -> Column:
    """The canonical form: '' for a text without letters and digits, null for null.

    ASCII letters are lower-cased and other characters kept, so that two texts in another
    script never meet. Only copyright notices ("All rights reserved" too, on a line of its own) and titles of
    licences that are published without one go: sentences of a licence stay however they are
    wrapped. Spellings are those of whole words, each for itself. In texts with conditions of
    redistribution, these may be numbered, lettered or bulleted, and the holder may be named (12 words at most).
    """
    return _whole(_lines(text))


def catalog(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = KNOWN, digests: list[tuple[str, int, str]] = DIGESTS) -> DataFrame:
    """(license, text) of known licences, and (license, length, digest) of canonical texts -> digest, length, license, one row per digest."""
    rows = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license string, text string")
    form = rows.where("text is not null").select("license", canonical(F.col("text")).alias("form")).where("form <> ''")
    all_known = form.select("license", F.length("form").alias("length"), F.sha2("form", 256).alias("digest"))
    all_known = all_known.unionByName(spark.createDataFrame(digests, "license string, length int, digest string"))
    return all_known.groupBy("digest", "length").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: list[tuple[str, str]] | DataFrame = KNOWN, digests: list[tuple[str, int, str]] = DIGESTS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, digest, license, line_licenses, n_license_lines.

    digest is that of the whole canonical text (null for a null text), license the known
    licence with that digest or null; line_licenses are the licences whose entire text is a
    line of the document, sorted, and n_license_lines counts such lines. A row for a row:
    rows equal in doc_id and text, null ones too, are looked up together and stay as many, so
    a task that runs again finds the same groups. Other columns aren't read. Blank units match
    nothing. Only lines as long as some known text are digested (for catalogs of at most
    LENGTHS lengths), and the catalog is broadcast if it has at most BROADCAST_ROWS rows; a
    larger one joins by shuffle.
    """
    catalogued = catalog(docs.sparkSession, known, digests)
    lengths = [r.length for r in catalogued.select("length").distinct().limit(LENGTHS + 1).collect()]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    read = rows.select("doc_id", F.sha2("text", 256).alias("text"), _lines(F.col("text")).alias("lines"))
    alike = (lambda x: (x != "") & F.length(x).isin(lengths)) if len(lengths) <= LENGTHS else (lambda x: x != "")
    each = F.filter(F.transform(F.split("lines", "\n"), lambda x: F.regexp_replace(_plain(x), TITLE, "")), alike)
    one = lambda whole, x: F.struct(F.lit(whole).alias("whole"), F.sha2(x, 256).alias("digest"))
    units = read.select("doc_id", "text", F.inline(F.concat(F.array(one(True, _whole(F.col("lines")))), F.coalesce(F.transform(each, lambda x: one(False, x)), F.array()))))
    found = units.join(small(catalogued.select("digest", "license")), "digest", "left").where("whole or license is not null")
    line = F.when(~F.col("whole"), F.col("license"))
    return (
        found.groupBy("doc_id", "text")
        .agg(
            F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"), F.max(F.when(F.col("whole"), F.col("license"))).alias("license"),
            F.array_sort(F.collect_set(line)).alias("line_licenses"), F.count(line).alias("n"), F.count_if("whole").alias("copies"),
        )
        .select("doc_id", "digest", "license", "line_licenses", (F.col("n") / F.col("copies")).cast("long").alias("n_license_lines"), F.explode(F.sequence(F.lit(1), "copies")))
        .drop("col")
    )


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    """Word by word: each is spelled for itself, then phrases are replaced in the joined words."""
    out = f"regexp_replace(translate({text}, '{_UPPER}', '{_LOWER}'), '{COPYRIGHT_LINE}', '', 'g')"
    cases = " ".join(f"WHEN '{a}' THEN '{b.replace(' ', '  ')}'" for a, b in SPELLINGS.items())
    out = f"array_to_string(list_transform(regexp_extract_all({out}, '[{KEPT}]+'), lambda w: ' ' || CASE w {cases} ELSE w END || ' '), '')"
    for a, b in PHRASES.items():
        out = f"replace({out}, ' {a.replace(' ', '  ')} ', ' {b.replace(' ', '  ')} ')"
    title = TITLE.replace("(?=permission |redistribution )", "(permission |redistribution )")
    out = f"trim(replace({out}, '  ', ' '))"
    filled = "x"
    for found, to in SLOTS:
        filled = f"regexp_replace({filled}, '{found}', '{to}', 'g')"
    out = f"list_transform([{out}], lambda x: CASE WHEN contains(x, '{SLOTS_IN}') THEN {filled} ELSE x END)[1]"
    return f"regexp_replace({out}, '{title}', '\\1')"


def scan_sql() -> str:
    """DuckDB SQL for the rows of scan() with the lists joined by commas."""
    values = ", ".join(f"({_sql_text(a)}, {_sql_text(b)})" for a, b in KNOWN)
    digests = ", ".join(f"('{a}', '{d}')" for a, _, d in DIGESTS)
    return f"""
WITH known AS (SELECT digest, min(license) AS license FROM (
  SELECT license, sha256({_sql_canonical("text")}) AS digest FROM (VALUES {values}) v(license, text) UNION ALL SELECT * FROM (VALUES {digests}) w(license, digest)) GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id, text, sha256({_sql_canonical("text")}) AS digest FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
canon AS (SELECT r, {_sql_canonical("line")} AS line FROM lines),
hits AS (SELECT r, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
  FROM canon JOIN known ON known.digest = sha256(line) WHERE line <> '' GROUP BY r)
SELECT doc_id, d.digest, license, coalesce(names, '') AS line_licenses, coalesce(n, 0)::BIGINT AS n_license_lines
FROM d LEFT JOIN known USING (digest) LEFT JOIN hits USING (r)"""

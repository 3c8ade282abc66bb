"""Licence scans by canonical digest: normalise whole texts and lines, hash them, and join the digests to known ones.

Canonical form: lower case, no copyright lines, equivalent spellings made one, every run of other characters than a-z and
0-9 one blank. Texts without any of the words that each known text has cannot match and are not hashed.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines that name a holder, not terms; matched after lower-casing.
COPYRIGHT_LINES = r"(?m)^[^a-z0-9\n]*(?:copyright (?:\(c\)|©|[0-9])|\(c\)|©|all rights reserved)[^\n]*$"
#: Equivalent spellings, in the order in which they are replaced.
SPELLINGS = (("licenc", "licens"), ("sub-licens", "sublicens"), ("non-infring", "noninfring"), ("merchantibility", "merchantability"), ("copyright owner", "copyright holder"), ("https:", "http:"), ("favour", "favor"), ("authoris", "authoriz"), ("organis", "organiz"), ("&", " and "))
#: Every known text has one of these, in some spelling, in any case.
WORDS = r"(?i)licen[cs]|permission|redistribut|warrant|public[^a-z0-9]+domain"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

#: Whole texts of licences, with and without their title, and one-line notices; (licence, text).
KNOWN = (
    *(("MIT", t + _MIT) for t in ("", "MIT License\n", "The MIT License\n", "The MIT License (MIT)\n")),
    *(("ISC", t + _GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_END) for t in ("", "ISC License\n")),
    *(("0BSD", t + _GRANT + ".\n" + _ISC_END) for t in ("", "BSD Zero Clause License\n", "Zero-Clause BSD\n")),
    *(("BSD-2-Clause", t + _BSD + _BSD_END) for t in ("", "BSD 2-Clause License\n")),
    *(("BSD-3-Clause", t + _BSD + _BSD_THIRD + _BSD_END) for t in ("", "BSD 3-Clause License\n")),
    *(("Zlib", t + _ZLIB) for t in ("", "zlib License\n")),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is in the public domain."),
    *((i, f"SPDX-License-Identifier: {i}") for i in ("MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "Apache-2.0", "GPL-3.0-only", "CC-BY-4.0")),
)

#: SHA-256 of the canonical forms of longer licences' whole texts, as published (a Debian system has them in
#: /usr/share/common-licenses, from which the tests make them again). Fixed values.
LONG_TEXTS = (
    ("Apache-2.0", "0be25ae8b112b6c47bf696a745855eebba678079747ad8bbf877d928555027f1"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "312d60d6637eaa5485742576ef2bf899e0513899a4e98cc9a1a6c688423c3ca6"),
    ("MPL-2.0", "92e88af3b436afcb6eef8128c9d1a7b2c6312377163ae31dfbacec094f33ab64"),
)


def canonical(text: str) -> str:
    s = re.sub(COPYRIGHT_LINES, "", text.lower())
    for a, b in SPELLINGS:
        s = s.replace(a, b)
    return re.sub("[^a-z0-9]+", " ", s).strip(" ")


def digest(text: str) -> str:
    return hashlib.sha256(canonical(text).encode()).hexdigest()


def known_digests(known=KNOWN) -> dict[str, str]:
    """digest -> licence; every text must have one of WORDS, else it could not be found."""
    for _, text in known:
        if not re.search(WORDS, text):
            raise ValueError(f"a known text has none of the words looked for: {text[:60]!r}")
    return {d: name for name, d in LONG_TEXTS} | {digest(text): name for name, text in known}


def canonical_column(text: Column) -> Column:
    s = F.regexp_replace(F.lower(text), F.lit(COPYRIGHT_LINES), F.lit(""))
    for a, b in SPELLINGS:
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(s, "[^a-z0-9]+", " "))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known=KNOWN) -> DataFrame:
    """(id, license, notices) a row: the licence that the entire text is, and those that entire lines of it are.

    license is null without a match, notices a comma-separated list in order (empty without a match, as for null and empty
    texts). Rows of one id share what is found in any of them; null ids find nothing. Other columns are left out.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORDS))
    whole = F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("unit")))
    units = rows.filter(F.col("id").isNotNull() & F.col("text").rlike(WORDS)).select("id", F.explode(F.concat(whole, F.transform(lines, lambda x: F.struct(F.lit(False).alias("whole"), x.alias("unit"))))).alias("u"))
    hashed = units.select("id", "u.whole", F.sha2(canonical_column(F.col("u.unit")).cast("binary"), 256).alias("digest"))
    table = spark.createDataFrame(sorted(known_digests(known).items()), "digest string, name string")  # a constant of this module
    found = hashed.join(F.broadcast(table), "digest").groupBy("id").agg(F.max(F.when(F.col("whole"), F.col("name"))).alias("license"), F.array_join(F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("name")))), ",").alias("notices"))
    out = rows.select("id").join(found, "id", "left")
    return out.select(F.col("id").alias(id_col), "license", F.coalesce("notices", F.lit("")).alias("notices"))


def scan_sql(known=KNOWN) -> str:
    """DuckDB SQL of scan() over documents."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    s = f"regexp_replace(lower(unit), {quote(COPYRIGHT_LINES)}, '', 'g')"
    for a, b in SPELLINGS:
        s = f"replace({s}, {quote(a)}, {quote(b)})"
    s = f"trim(regexp_replace({s}, '[^a-z0-9]+', ' ', 'g'))"
    values = ", ".join(f"({quote(d)}, {quote(n)})" for d, n in sorted(known_digests(known).items()))
    return f"""
WITH known(digest, name) AS (VALUES {values}),
units AS (
  SELECT doc_id, true AS whole, text AS unit FROM documents WHERE regexp_matches(text, {quote(WORDS)})
  UNION ALL SELECT doc_id, false, unit FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM documents) WHERE regexp_matches(unit, {quote(WORDS)})),
found AS (
  SELECT doc_id, max(CASE WHEN whole THEN name END) AS license, string_agg(DISTINCT CASE WHEN NOT whole THEN name END, ',' ORDER BY CASE WHEN NOT whole THEN name END) AS notices
  FROM (SELECT doc_id, whole, sha256({s}) AS digest FROM units) JOIN known USING (digest) GROUP BY doc_id)
SELECT d.doc_id, license, coalesce(notices, '') AS notices FROM documents d LEFT JOIN found USING (doc_id)
"""

"""Licence scan by canonical digests.

A text is brought to a canonical form (case, copyright lines, equivalent spellings, punctuation and white
space), hashed, and hash-joined with the digests of known licences. Whole texts are looked up, and each
of their lines, since notices mostly stand as a line of a longer text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txloom.llm.shared import texts

# Texts of public licences and the notices that name one.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ZERO_BSD = ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_3 = BSD_2.replace(
    "THIS SOFTWARE",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE",
    1,
)
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
GPL_3_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
MPL_HEADER = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
#: Licence texts, and the titles that may stand above them.
TITLED: list[tuple[str, str, list[str]]] = [
    ("MIT", MIT, ["MIT License", "The MIT License", "The MIT License (MIT)"]),
    ("ISC", ISC, ["ISC License", "The ISC License"]),
    ("ISC", ISC.replace("and/or", "and"), ["ISC License", "The ISC License"]),
    ("0BSD", ZERO_BSD, ["BSD Zero Clause License", "Zero-Clause BSD"]),
    ("Zlib", ZLIB, ["zlib License", "The zlib License"]),
    ("BSD-2-Clause", BSD_2, ["BSD 2-Clause License", "The 2-Clause BSD License"]),
    ("BSD-3-Clause", BSD_3, ["BSD 3-Clause License", "The 3-Clause BSD License"]),
    ("BSL-1.0", BOOST, []),
    ("Unlicense", UNLICENSE, []),
    ("Apache-2.0", APACHE_HEADER, []),
    ("GPL-3.0-or-later", GPL_3_HEADER, []),
    ("AGPL-3.0-or-later", GPL_3_HEADER.replace("GNU General", "GNU Affero General"), []),
    ("MPL-2.0", MPL_HEADER, []),
]
NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]
#: SHA-256 of the canonical forms of long licence texts in their published form, appendices included.
DIGESTS: list[tuple[str, str]] = [
    ("Apache-2.0", "7344d7b010ed06669d02fd695b0ad14b4f233520668c35c46d585f981ed64e02"),
    ("GPL-2.0", "c683128a79af968653f7a06709159e41adcfcb00ca1e8ab9ffa1d516dcf82123"),
    ("GPL-3.0", "ed736950e486722651f2ab9a3b20771f60da3fc81f6430b5a3e6063e5b1ee2ff"),
    ("LGPL-2.1", "1062ffac76908393fc69253f7145220e8c21bf220cdeb043b5289e5dc964ccd0"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-2.0", "3dacd2c104719e7227969cbdcc7d581518827199e830b9379627eec0a32f8ab7"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
]


def _known() -> list[tuple[str, str]]:
    """Each text alone and below its titles, its clauses numbered and unnumbered; each notice; a line of the short form for each licence."""
    out = []
    for name, text, titles in TITLED:
        for form in dict.fromkeys((text, re.sub(r"(?m)^\d\. ", "", text))):
            out += [(name, form), *((name, f"{title}\n\n{form}") for title in titles)]
    names = dict.fromkeys(name for name, *_ in (*TITLED, *NOTICES, *DIGESTS))
    return [*out, *NOTICES, *((name, f"SPDX-License-Identifier: {name}") for name in names)]


KNOWN: list[tuple[str, str]] = _known()
# Spellings that licence matching takes as one.
SPELLINGS: list[tuple[str, str]] = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("sub licence", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("organisation", "organization"),
    ("recognised", "recognized"),
    ("modelled", "modeled"),
    ("per cent", "percent"),
    ("wilful", "willful"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holder"),
    ("copyright holders", "copyright holder"),
    ("http", "https"),
]
# Words after "copyright" with which a line goes on with a licence text, as lines are broken anywhere.
NO_NOTICE = "notice|notices|license|licenses|licence|licences|holder|holders|owner|owners|law|laws|interest|interests|statement|and|or|in|on|of|is|to"
#: A line may begin with marks of a comment. MARK keeps a line that begins with "copyright" from being taken for a notice.
MARK = "\x01"
GOES_ON = r"^([^\p{L}\p{N}\n]*)copyright[ \t]+(" + NO_NOTICE + r")([^\p{L}\p{N}]|$)"
COPYRIGHT_LINE = r"^[^\p{L}\p{N}\n\x01]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
PUNCTUATION = r"[^\p{L}\p{N}\n]+"
#: Registries up to this many rows are sent to every task, larger ones are joined by a shuffle.
BROADCAST_ROWS = 20_000


def canonical_lines(text: Column) -> Column:
    """The text in canonical form but for spellings, its lines kept apart: copyright lines go, also those in comments."""
    text = F.regexp_replace(F.lower(text), "(?md)" + GOES_ON, f"$1{MARK}copyright $2$3")
    text = F.regexp_replace(text, "(?md)" + COPYRIGHT_LINE, "")
    return F.regexp_replace(F.concat(F.lit(" "), F.regexp_replace(text, PUNCTUATION, " "), F.lit(" ")), "\n", " \n ")


def respelled(form: Column) -> Column:
    """Equivalent spellings made one."""
    out = form
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.when(form.rlike(" (" + "|".join(old for old, _ in SPELLINGS) + ") "), out).otherwise(form)


def one_line(form: Column) -> Column:
    return F.regexp_replace(form, r"\s+", " ")


def digest(form: Column) -> Column:
    """The digest of a form on one line."""
    return F.sha2(F.trim(form), 256)


def text_digest(text: Column) -> Column:
    """The digest of a whole text; where its lines are broken makes no difference."""
    return digest(respelled(one_line(canonical_lines(text))))


def registry(spark, known: list[tuple[str, str]] = KNOWN, digests: list[tuple[str, str]] = DIGESTS) -> DataFrame:
    """license_id, digest of known texts and known digests; of texts with one canonical form the first name counts."""
    frame = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(known)], "n long, license_id string, text string")
    frame = frame.select("n", "license_id", text_digest(F.col("text")).alias("digest"))
    more = spark.createDataFrame([(len(known) + k, *row) for k, row in enumerate(digests)], frame.schema)
    return frame.unionByName(more).groupBy("digest").agg(F.min_by("license_id", "n").alias("license_id"))


def license_matches(
    docs: DataFrame,
    known: list[tuple[str, str]] = KNOWN,
    id_column: str = "doc_id",
    text_column: str = "text",
    digests: list[tuple[str, str]] = DIGESTS,
) -> DataFrame:
    """doc_id, unit ('text' or 'line'), line (0 for the text, else from 1), license_id: a row for each match.

    A text of one line that is a notice matches both as text and as line. Null, empty and blank texts match
    nothing, as no known text is blank. Each row is looked up for itself: repeated rows give repeated matches,
    a null id stays null. Without known texts there is no match.
    """
    forms = texts(docs, id_column, text_column).select("doc_id", canonical_lines(F.col("text")).alias("form"))
    forms = forms.select("doc_id", respelled(one_line(F.col("form"))).alias("whole"), respelled(F.col("form")).alias("form"))
    units = forms.select("doc_id", F.posexplode(F.concat(F.array("whole"), F.split("form", "\n"))).alias("line", "form")).where(F.trim("form") != "")
    names = registry(docs.sparkSession, known, digests)
    if len(known) + len(digests) <= BROADCAST_ROWS:
        names = F.broadcast(names)
    return (
        units.withColumn("digest", digest(F.when(F.col("line") == 0, F.col("form")).otherwise(one_line(F.col("form")))))
        .join(names, "digest")
        .select("doc_id", F.when(F.col("line") == 0, "text").otherwise("line").alias("unit"), F.col("line").cast("long").alias("line"), "license_id")
    )


def duckdb_sql(known: list[tuple[str, str]] = KNOWN, digests: list[tuple[str, str]] = DIGESTS) -> str:
    """The same over the view `documents`, as DuckDB SQL."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"

    def spelled(t: str) -> str:
        for old, new in SPELLINGS:
            t = f"replace({t}, ' {old} ', ' {new} ')"
        return t

    def canon(source: str) -> str:
        marked = rf"regexp_replace(lower(raw), '(?m){GOES_ON}', '\1' || chr({ord(MARK)}) || 'copyright \2\3', 'g')"
        bare = f"regexp_replace(regexp_replace({marked}, '(?m){COPYRIGHT_LINE}', '', 'g'), '{PUNCTUATION}', ' ', 'g')"
        lines = f"SELECT *, replace(' ' || {bare} || ' ', chr(10), ' ' || chr(10) || ' ') AS t FROM {source}"
        return f"SELECT *, {spelled('t')} AS form, {spelled(one_line_('t'))} AS whole FROM ({lines})"

    one_line_ = lambda t: rf"regexp_replace({t}, '\s+', ' ', 'g')"
    rows = ", ".join(f"({k}, {quote(name)}, {quote(text)})" for k, (name, text) in enumerate(known))
    more = "".join(f" UNION ALL SELECT {len(known) + k}, {quote(name)}, {quote(value)}" for k, (name, value) in enumerate(digests))
    texts_ = canon(f"(SELECT n, license_id, raw FROM (VALUES {rows}) v(n, license_id, raw))")
    return f"""
WITH known AS (SELECT digest, arg_min(license_id, n) AS license_id
    FROM (SELECT n, license_id, sha256(trim(whole)) AS digest FROM ({texts_}){more}) GROUP BY 1),
forms AS ({canon("(SELECT doc_id, coalesce(text, '') AS raw FROM documents)")}),
units AS (SELECT doc_id, 'text' AS unit, 0::BIGINT AS line, whole AS form FROM forms
    UNION ALL SELECT doc_id, 'line', unnest(range(1, len(string_split(form, chr(10))) + 1)), unnest(string_split(form, chr(10))) FROM forms)
SELECT doc_id, unit, line, license_id FROM units JOIN known ON known.digest = sha256(trim({one_line_("units.form")}))
WHERE trim(units.form) <> ''
"""

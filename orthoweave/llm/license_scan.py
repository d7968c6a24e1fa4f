"""License scans: canonical digests of whole texts, and of each line, looked up among those of known licences.

The canonical form is lower case without copyright lines; runs of other characters than letters and digits are one
blank; equivalent spellings are one spelling. SHA-256 digests of the form are joined by hash; nothing but equality of
entire canonical texts is a match.

Cases: a null, empty or punctuation-only text matches nothing; equal rows get equal results; a text known under several
names has the first by name; no rows give none; with no known licence nothing matches; extra columns are ignored.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Known digests up to this number are sent to every executor; more are joined by shuffle.
BROADCAST_DIGESTS = 200_000
_LINE = r"(?m)^[^\p{L}\p{N}\n(©]*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]*$"

# Equivalent spellings, from the public matching guidelines of licence lists.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "catalogue": "catalog",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
    "merchantibility": "merchantability",
    "sub license": "sublicense",
    "sub licenses": "sublicenses",
    "non commercial": "noncommercial",
    "per cent": "percent",
    "copyright owner": "copyright holder",
    "http": "https",
}

# Texts of short public licences, and the notices that name a licence.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}
NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the MIT License.": "MIT",
    "SPDX-License-Identifier: MIT": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    "SPDX-License-Identifier: GPL-3.0-only": "GPL-3.0-only",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
}

# First lines that a text may have or lack.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "FreeBSD License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "Modified BSD License", "BSD License"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
#: How many lines that aren't empty a longer text has for a title.
HEADS = {"Apache-2.0": 3, "Artistic-1.0-Perl": 1, "CC0-1.0": 2, "MPL-1.1": 3} | {k: 2 for k in ("GFDL-1.2-only", "GFDL-1.3-only", "GPL-1.0-only", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0")}
_END = re.compile(r"(?m)^.*END OF TERMS AND CONDITIONS.*$")


def texts() -> list[tuple[str, str]]:
    """License and text: entire texts, from KNOWN and the folder licenses, in the forms in which they are passed on.

    These are with each title and without one, with the guide that follows some of them, without it and without the line
    before it, and with lines as in the usual files or a line a paragraph: a line that begins with the word copyright is not
    in the canonical form, so where lines break counts.
    """
    folder = Path(__file__).with_name("licenses")
    bodies = [*KNOWN.items(), *((f.stem, f.read_text("utf-8")) for f in sorted(folder.glob("*.txt")))]
    got = {}
    for name, body in bodies:
        lines = body.splitlines()
        titles, start = TITLES.get(name, ()), 0
        for _ in range(HEADS.get(name, 0)):
            start += next(i for i, x in enumerate(lines[start:]) if x.strip()) + 1
        end = _END.search(body)
        for form in [body, "\n".join(lines[start:])]:
            ends = [form] + ([form[: m.end()], form[: m.start()]] if end and (m := _END.search(form)) else [])
            for x in ends:
                for y in (x, re.sub(r"(?<=\S)[ \t]*\n[ \t]*(?=\S)", " ", x)):
                    for title in ("", *titles):
                        got[name, f"{title}\n\n{y}"] = None
    return list(got)


def canonical(text: Column) -> Column:
    """The canonical form, a line end between blanks where lines part; leading and trailing blanks stay."""
    got = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _LINE, "")
    got = F.regexp_replace(got, r"[^\p{L}\p{N}\n]+", " ")
    got = F.concat(F.lit(" "), F.replace(got, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    return F.replace(got, F.lit("  "), F.lit(" "))


def _lines(form: Column) -> Column:
    """Lines that aren't empty, in one spelling. Only a text that holds another spelling is gone through."""
    ruled = F.rlike(form, F.lit(" (?:" + "|".join(SPELLINGS) + ") "))
    return F.filter(F.transform(F.split(F.when(ruled, _spelled(form)).otherwise(form), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def _spelled(form: Column) -> Column:
    for old, new in SPELLINGS.items():
        for _ in range(2):  # neighbours share a blank
            form = F.replace(form, F.lit(f" {old} "), F.lit(f" {new} "))
    return form


def known(spark: SparkSession) -> DataFrame:
    """license, text: the built-in licences and notices."""
    return spark.createDataFrame([*texts(), *((v, k) for k, v in NOTICES.items())], "license string, text string")


def scan(docs: DataFrame, licenses: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, license (of the entire text, or null), notices (licences that entire lines name, sorted), n_notices."""
    digest = lambda lines: F.sha2(F.array_join(lines, " "), 256)
    table = licenses.select(F.col("license").alias("name"), _lines(canonical(F.col("text"))).alias("lines")).filter(F.size("lines") > 0)
    table = table.select("name", digest(F.col("lines")).alias("known")).groupBy("known").agg(F.min("name").alias("name"))
    few = table.count() <= BROADCAST_DIGESTS
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).alias("doc_id"), canonical(F.col(text)).alias("form")).select("uid", "doc_id", _lines(F.col("form")).alias("lines"))
    whole = F.array(F.when(F.size("lines") > 0, digest(F.col("lines"))))
    parts = rows.select("uid", "doc_id", F.posexplode(F.concat(whole, F.transform("lines", lambda x: F.sha2(x, 256)))).alias("at", "asked"))
    met = parts.join(F.broadcast(table) if few else table, F.col("asked") == F.col("known"), "left").filter((F.col("at") == 0) | F.col("name").isNotNull())
    got = met.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.max(F.when(F.col("at") == 0, F.col("name"))).alias("license"), F.array_sort(F.collect_set(F.when(F.col("at") > 0, F.col("name")))).alias("found"), F.count_if(F.col("at") > 0).alias("n_notices"))
    return got.select("doc_id", "license", F.array_join("found", ",").alias("notices"), "n_notices")

"""Licence scan: TF-IDF cosine to templates, then inheritance from the nearest ancestor folder.

A file that speaks of a licence is compared piece by piece: its whole text (as licence files are), each block of
lines (as headers are) and each sentence or line (as notices and SPDX lines are) becomes
a sparse vector.  The join with the templates' vectors is on terms, so only shared terms
meet.  Folders that hold a licence file hand it down: a file without a licence of its own
takes that of the nearest folder above it, found by joins on folder paths.  All steps are
built-in expressions.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.tables import stored

# Public licence texts, the notices their authors ask for, and usual short forms.
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published "
    "by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
)
_GNU_FIRST = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published "
    "by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
_GNU = (
    ("GPL-2.0", "GNU General Public License", "2", "June 1991"),
    ("GPL-3.0", "GNU General Public License", "3", "29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "19 November 2007"),
)
_SPDX = (
    "MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0",
    "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "Unlicense", "Zlib", "CC0-1.0",
    "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
)
TEMPLATES = (
    ("MIT", "The MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
     "above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "This project is licensed under the terms of the MIT license"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
     '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
     "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
     "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
     "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("ISC", "Released under the ISC License"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_WARRANTY}"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-3-Clause", f"{_BSD} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     f"promote products derived from this software without specific prior written permission. {_BSD_WARRANTY}"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms BSD 3-Clause License"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
     'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
     "License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    *((name, f"{title} Version {version}, {date}") for name, title, version, date in _GNU),
    *((name, _GNU_NOTICE.format(name=title, version=version)) for name, title, version, _ in _GNU),
    *((name, _GNU_FIRST.format(name=title, version=version)) for name, title, version, _ in _GNU),
    *((name, f"This work is licensed under the {title}, version {version}") for name, title, version, _ in _GNU),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
     "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
     "commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
     "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
     "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("proprietary", "All rights reserved"),
    ("proprietary", "Copyright. All rights reserved."),
    *((name.removesuffix("-only").removesuffix("-or-later"), f"SPDX-License-Identifier: {name}") for name in _SPDX),
)

#: What a text that speaks of a licence holds somewhere.
HINT = r"(?i)licen[sc]e|spdx|copyright|rights reserved|creative commons|public domain|redistribut|permission|provided .?as.is"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: The end of a sentence, and lines without a letter or digit between blocks.
SENTENCE_END, BLOCK_END = r"([.!?;])[ \t\r\n]", r"\n(?:[^A-Za-z0-9\n]*\n)+"
#: Similarity from which a template counts, and that of a whole text which is a licence file.
LEAST_SIMILARITY, FILE_SIMILARITY = 0.6, 0.85
#: What a text that grants nothing is called.
NO_LICENCE = "proprietary"
#: Names of licence files.
_FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|notice)(\.[a-z]+)?$"


def _template_terms() -> list[list[str]]:
    return [re.findall(TERM, text.lower()) for _, text in TEMPLATES]


def weights() -> tuple[dict[str, float], float]:
    """Inverse document frequency of each template term, and that of any other term."""
    terms = _template_terms()
    n = len(terms)
    idf = {t: math.log((1 + n) / (1 + sum(t in x for x in terms))) + 1 for x in terms for t in x}
    return idf, math.log(1 + n) + 1


def vectors() -> list[tuple[str, int, str, float]]:
    """Term, template number, licence and weight in a vector of length one; as many rows as the templates have terms."""
    idf, _ = weights()
    rows = []
    for number, ((licence, _), terms) in enumerate(zip(TEMPLATES, _template_terms())):
        vector = {t: terms.count(t) * idf[t] for t in terms}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        rows += [(t, number, licence, v / norm) for t, v in sorted(vector.items())]
    return rows


def template_vectors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(vectors(), "term string, template int, licence string, weight double")


def term_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(weights()[0].items()), "term string, idf double")


def pieces(body: Column) -> Column:
    """The whole text, then the sentences and lines, then the blocks of lines that speak of a licence."""
    sentences = F.split(F.regexp_replace(body, SENTENCE_END, "$1\n"), "\n", -1)
    blocks = F.split(F.regexp_replace(body, BLOCK_END, "\u0001"), "\u0001", -1)
    speaking = lambda x: x.rlike(HINT)
    return F.concat(F.array(body), F.filter(sentences, speaking), F.filter(blocks, speaking))


def own_licences(files: DataFrame) -> DataFrame:
    """``path``, ``mark``, ``licence``, ``similarity``, ``is_file`` of the files that name a licence.

    ``files`` has ``path``, ``text`` and ``mark``, a hash of both.  The most similar template counts, of
    equal ones the first in order.  Counts are sums over equal rows, which leaves the
    angle as it is, so repeated rows score like single ones.
    """
    spark, at = files.sparkSession, ["mark", "piece"]
    body = F.coalesce("text", F.lit(""))
    heads = files.where(body.rlike(HINT)).select("path", "mark", body.alias("body"))
    said = heads.select("mark", F.posexplode(pieces(F.col("body"))).alias("piece", "said"))
    said = said.select(*at, F.explode(F.regexp_extract_all(F.lower("said"), F.lit(f"({TERM})"))).alias("term"))
    # Counts per piece and term are added up before they are shuffled; terms travel as hashes.
    counted = said.groupBy(*at, F.xxhash64("term").alias("term")).agg(F.count(F.lit(1)).alias("n"))
    # The templates are a fixed list of some thousand terms.
    known = F.broadcast(term_weights(spark).withColumn("term", F.xxhash64("term")))
    weighed = counted.join(known, "term", "left").select(
        *at, "term", (F.col("n") * F.coalesce("idf", F.lit(weights()[1]))).alias("w")
    )
    length = weighed.groupBy(*at).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    shared = weighed.join(F.broadcast(template_vectors(spark).withColumn("term", F.xxhash64("term"))), "term")
    dots = shared.groupBy(*at, "template", "licence").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(length, at).withColumn("similarity", F.round(F.col("dot") / F.col("length"), 6))
    # Licences themselves say that all rights are reserved, so any other finding goes first.
    named = (F.col("licence") != NO_LICENCE).alias("named")
    best = scored.where(F.col("similarity") >= LEAST_SIMILARITY).groupBy("mark").agg(
        F.max(F.struct(named, "similarity", (-F.col("template")).alias("t"), "licence")).alias("b"),
        F.max(F.when(F.col("piece") == 0, F.col("similarity"))).alias("whole"),
    )
    is_file = F.col("path").rlike(_FILE_NAME) | (F.coalesce("whole", F.lit(0.0)) >= FILE_SIMILARITY)
    # The mark is a hash of path and text: each path and mark once.
    found = heads.select("path", "mark").distinct().join(best, "mark")
    return found.select("path", "mark", "b.licence", "b.similarity", is_file.alias("is_file"))


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan(files: DataFrame) -> DataFrame:
    """``path``, ``licence``, ``similarity``, ``origin`` and ``inherited_from`` of every row of ``files``.

    ``origin`` is ``file`` or ``header`` for a licence of its own, ``inherited``, or ``none``.  A file is a
    licence file by its name, or if its whole text is like a template.
    A folder's licence is that of the licence file in it with the highest similarity (then
    the smallest path).  Null and empty texts name no licence; null paths name and inherit none.  Repeated
    rows are told apart by text and score like single ones.  Texts are read whole, however long: a
    term costs a row.  Other columns are not read.  An empty table gives no rows.
    """
    marked = files.select("path", "text", F.xxhash64("path", F.coalesce("text", F.lit(""))).alias("mark"))
    # Written once: folders and files both look into it.
    own = stored(own_licences(marked.where("path is not null")), "licences")
    holders = (
        own.where("is_file")
        .groupBy(_folder(F.col("path")).alias("folder"))
        .agg(F.min(F.struct((-F.col("similarity")).alias("s"), "path", "licence")).alias("x"))
        .select("folder", F.col("x.licence").alias("held"))
    )
    # Folders, not files, look for ancestors: each once, however many files it has.
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    folders = files.where("path is not null").select(_folder(F.col("path")).alias("folder")).distinct()
    climbs = folders.select("folder", F.posexplode(above).alias("steps", "ancestor"))
    nearest = (
        climbs.join(holders.withColumnRenamed("folder", "ancestor"), "ancestor")
        .groupBy("folder")
        .agg(F.min(F.struct("steps", "ancestor", "held")).alias("x"))
        .select("folder", "x.ancestor", "x.held")
    )
    named = marked.select("path", "mark").join(own, ["path", "mark"], "left").withColumn("folder", _folder(F.col("path")))
    placed = named.join(nearest, "folder", "left")
    mine = F.col("licence").isNotNull()
    return placed.select(
        "path",
        F.coalesce("licence", "held").alias("licence"),
        "similarity",
        F.when(mine & F.col("is_file"), "file").when(mine, "header").when(F.col("held").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("ancestor")).alias("inherited_from"),
    )

"""Licence scan on licence files, headers and notices as projects have them, written here apart from the templates."""

import time

import pytest
from pyspark.sql import functions as F

from tidelog.llm import licenses

MIT = """MIT License

Copyright (c) 2019 Jane Roe and others

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""

APACHE_HEADER = """#
# Licensed to the Example Foundation under one or more contributor agreements.
#
# Licensed under the Apache License, Version 2.0 (the "License"); you may not
# use this file except in compliance with the License.  You may obtain a copy of
# the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
# WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
#
import os


def run(path):
    return [name for name in os.listdir(path) if name.endswith(".txt")]
"""

APACHE_FILE = """
                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions.

      "License" shall mean the terms and conditions for use, reproduction,
      and distribution as defined by Sections 1 through 9 of this document.

      "Licensor" shall mean the copyright owner or entity authorized by
      the copyright owner that is granting the License.
"""

GPL_FILE = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

                            Preamble

  The GNU General Public License is a free, copyleft license for
software and other kinds of works.
"""

GPL_HEADER = """/* frob.c - frobnicates
 *
 * Copyright (C) 2011 A. Person
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 2 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
 */
int main(void) { return 0; }
"""

BSD_3 = """Copyright (c) 2008, The Example Authors. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
BSD_2 = BSD_3[: BSD_3.index("3. Neither")] + BSD_3[BSD_3.index("THIS SOFTWARE") :]

ISC = """Copyright 2020 Somebody <some@body.example>

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS.
"""

MPL_HEADER = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */

let x = 1;
"""

PROSE = "It was a long walk home and the rain had not stopped since noon. Nobody spoke. "

FOUND = [
    ("LICENSE", MIT, "MIT", "file"),
    ("MIT-first-half", MIT[: len(MIT) // 2], "MIT", "file"),
    ("a.py", APACHE_HEADER, "Apache-2.0", "header"),
    ("LICENSE.txt", APACHE_FILE, "Apache-2.0", "file"),
    ("COPYING", GPL_FILE, "GPL-3.0", "file"),
    ("frob.c", GPL_HEADER, "GPL-2.0", None),
    ("LICENSE.md", BSD_3, "BSD-3-Clause", "file"),
    ("two/LICENSE", BSD_2, "BSD-2-Clause", "file"),
    ("isc/LICENSE", ISC, "ISC", "file"),
    ("x.js", MPL_HEADER, "MPL-2.0", None),
    ("s.c", "// SPDX-License-Identifier: MIT\nint x;\n" + "int y;\n" * 40, "MIT", "header"),
    ("s.h", "/* SPDX-License-Identifier: Apache-2.0 */\nint x;\n" + "int y;\n" * 40, "Apache-2.0", "header"),
    ("s.rs", "// SPDX-License-Identifier: GPL-3.0-or-later\nfn main() {}\n" + "// run\n" * 40, "GPL-3.0", "header"),
    ("one-line.txt", PROSE * 5 + "Released under the MIT License. " + PROSE * 5, "MIT", "header"),
    ("cc.txt", PROSE + "\nLicensed under CC BY 4.0.\n" + PROSE * 3, "CC-BY-4.0", "header"),
]
NOT_FOUND = [
    ("driver.txt", "He lost his driving licence on the way to the public house and asked for permission to stay. " * 3),
    ("press.txt", "The licence fee will rise next year, the minister said. Copyright law is another matter."),
    ("unknown.c", "// SPDX-License-Identifier: Foo-Bar-9\nint x;"),
    ("plain.txt", PROSE * 4),
    ("null.txt", None),
    ("empty.txt", ""),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "path string, text string").withColumn("mark", F.lit(1)).withColumn("piece", F.lit("x"))


def test_real_texts_are_recognised(spark):
    rows = [(f"{k}/{name}", text) for k, (name, text, *_) in enumerate(FOUND)]
    rows += [(f"none/{name}", text) for name, text in NOT_FOUND]
    got = {r.path: r for r in licenses.scan(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for k, (name, _, licence, origin) in enumerate(FOUND):
        row = got[f"{k}/{name}"]
        assert row.licence == licence, (name, row)
        assert origin in (None, row.origin), (name, row)
        assert 0.6 <= row.similarity <= 1.000001
    for name, _ in NOT_FOUND:
        assert got[f"none/{name}"].origin == "none", got[f"none/{name}"]


def test_repeated_rows_score_like_single_ones(spark):
    one = [("a/LICENSE", MIT), ("a/x.txt", PROSE)]
    single = {tuple(r) for r in licenses.scan(frame(spark, one)).collect()}
    many = licenses.scan(frame(spark, one * 3)).collect()
    assert len(many) == 6 and {tuple(r) for r in many} == single
    # Another text at the same path is scored by itself; the folder takes the best.
    mixed = licenses.scan(frame(spark, [*one, ("a/LICENSE", "Released under the MIT License")])).collect()
    assert sorted((r.origin, r.licence) for r in mixed) == [("file", "MIT"), ("file", "MIT"), ("inherited", "MIT")]


def test_nearest_ancestor_hands_down(spark):
    rows = [("LICENSE", MIT), ("/r/COPYING", GPL_FILE), ("/r/a/b/c.txt", PROSE), ("/r/a/LICENSE", ISC), ("/r/x.txt", None), ("/rr/y", ""), (None, MIT)]
    got = {r.path: (r.licence, r.origin, r.inherited_from) for r in licenses.scan(frame(spark, rows)).collect()}
    assert got["/r/a/b/c.txt"] == ("ISC", "inherited", "/r/a")
    assert got["/r/x.txt"] == ("GPL-3.0", "inherited", "/r")
    assert got[None] == (None, "none", None)
    assert got["/rr/y"][1] in ("inherited", "none")


def test_long_lines_and_empty_tables(spark):
    line = "license " + " ".join(f"t{k}" for k in range(20_000))
    licenses.scan(frame(spark, [("w", MIT)])).collect()  # compiled
    started = time.monotonic()
    found = licenses.scan(frame(spark, [("long.txt", line)])).collect()
    assert [r.origin for r in found] == ["none"]
    assert time.monotonic() - started < 20
    assert licenses.scan(frame(spark, [])).count() == 0


def test_the_plan_has_no_python(spark):
    plan = licenses.scan(frame(spark, [("a", MIT)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("number", range(0, len(licenses.TEMPLATES), 7))
def test_template_vectors_have_length_one(number):
    assert sum(w * w for _, k, _, w in licenses.vectors() if k == number) == pytest.approx(1)

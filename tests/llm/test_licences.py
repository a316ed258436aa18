"""Licences in texts as they are published, and against the SQL on texts put together at random."""

import random
import time

import duckdb
import pytest

from roadledger.llm import licences, queries

from .conftest import ODD

MIT = """MIT License

Copyright (c) 2019 Some Body

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

GPL3 = """/*
 * A program that does something.
 * Copyright (C) 2020  Some Body
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 */
int main(void);
"""

GPL2 = """
; This program is free software; you can redistribute it and/or
; modify it under the terms of the GNU General Public License
; as published by the Free Software Foundation; either version 2
; of the License, or (at your option) any later version.
"""

APACHE = """#!/bin/sh
# Copyright 2018 Some Body
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""

MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */
"""

BSD3 = """Copyright 2011 Some Body

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
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""

PUBLISHED = [
    (MIT, ["MIT"]), (MIT.split("\n\n", 2)[2], ["MIT"]), (MIT.replace("\n", "\r\n"), ["MIT"]), (" ".join(MIT.split("\n\n")[2:]), ["MIT"]),
    (GPL3, ["GPL-3.0-or-later"]), (GPL2, ["GPL-2.0-or-later"]), (APACHE, ["Apache-2.0"]), (MPL, ["MPL-2.0"]),
    (BSD3, ["BSD-3-Clause"]), (BSD3.replace("3. Neither", "3. Nor").replace("Redistribution and", "\n* Redistribution and"), ["BSD-2-Clause"]),
    (ISC, ["ISC"]), (MIT + "\n" + APACHE, ["Apache-2.0", "MIT"]),
    ("SPDX-License-Identifier: MIT", ["MIT"]), ("// SPDX-License-Identifier: ISC\n#include <a.h>", ["ISC"]),
    ("# SPDX-License-Identifier: GPL-2.0+", ["GPL-2.0-or-later"]), ("SPDX-License-Identifier: GPL-2.0", ["GPL-2.0-only"]),
    ("/* SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause) */", ["BSD-3-Clause", "GPL-2.0-only"]),
    ("Some page\nReleased under the MIT License.", ["MIT"]), ("Some words. Licensed under\nCC BY-NC 4.0", ["CC-BY-NC-4.0"]),
    ("This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
    ("MIT License", []), ("released under the mit licenses", []), ("Not released under the MIT License", []),
    ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", []), ("Released under the MIT\n\nLicense", ["MIT"]),
]


@pytest.mark.parametrize("k", range(len(PUBLISHED)))
def test_published_wording_is_found(k):
    text, want = PUBLISHED[k]
    table = licences.rules()
    assert sorted(set(table.licences(table.sentence_ids(text)))) == want


def test_rules_and_sentences_are_clear():
    table = licences.rules()
    assert all(any(w in s for w in table.triggers) for s in table.known)
    # No rule begins in another one and ends outside it.
    heads = {r[:n] for r in table.licence_of for n in range(1, len(r))}
    assert not [r for r in table.licence_of for n in range(1, len(r)) if r[n:] in heads]


def test_every_row_and_shape(spark, texts):
    df = texts(*[(100 + k, t) for k, (t, _) in enumerate(PUBLISHED)], *ODD, (None, MIT), (None, MIT))
    got = licences.licences(df).collect()
    assert len(got) == len(PUBLISHED) + len(ODD) + 2
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(by_id[100 + k]["licences"] == ",".join(want) for k, (_, want) in enumerate(PUBLISHED))
    assert all((by_id[i]["sentence_ids"], by_id[i]["n_licences"]) == ("", 0) for i, _ in ODD if i)
    assert sorted(r["licences"] for r in got if r["doc_id"] is None) == ["", "MIT", "MIT"]
    assert licences.licences(df.limit(0)).count() == 0


def test_texts_put_together_equal_the_sql():
    rng = random.Random(5)
    table = licences.rules()
    bits = [*sorted(table.known), *(s.encode() for s, _ in PUBLISHED)]
    words = ["License", "version", "v. 2.0", "the", "Ünï", "\x01", "\x02", "identifier:", "2+", "日本"]
    texts = []
    for _ in range(300):
        parts = []
        for _ in range(rng.randrange(1, 12)):
            part = rng.choice(bits).decode() if rng.random() < 0.7 else rng.choice(words)
            if rng.random() < 0.3:
                part = part.replace(" ", "\n", rng.randrange(3)).title()
            parts.append(part + rng.choice((" ", "\n", "\n\n", ". ", ";\n", ": ", "\n * ", '.") ', "!\r\n", "\v")))
        texts.append("".join(parts))
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    want = {r[0]: r[1:] for r in con.execute(queries.ORACLE["op10_licences"]).fetchall()}
    found = 0
    for k, text in enumerate(texts):
        ids = table.sentence_ids(text)
        stated = table.licences(ids)
        assert (" ".join(ids), ",".join(sorted(set(stated))), len(stated)) == want[k], text
        found += len(stated)
    assert found > 300


def test_long_texts_take_linear_time():
    table = licences.rules()
    for text in ("mit license\n" * 200_000, "redistribution and use " * 200_000, "a" + "." * 2_000_000 + "license", "license" + ")" * 2_000_000 + "a", "\n " * 1_000_000 + "license", MIT * 500):
        begun = time.process_time()
        table.licences(table.sentence_ids(text))
        assert time.process_time() - begun < 10

import random
import re
import time

from pyspark.sql import functions as F

from tallyfold.llm import license_scan as ls

MIT = ls.RULES[3][2]
TEXTS = [
    None, "", "Released under the MIT License.", "x. Released under the\tMIT  license!\nLicensed under CC BY-NC 4.0.", "Released under the MIT License v2.",
    ". ".join(MIT) + ".", f"{MIT[1]}. {MIT[0]}.", f"Hello.\n{MIT[0]}. Something else; {MIT[1]}. End", "Licensed under the Apache License, Version 2.0.",
    "\n".join(s + "." for s in ls.RULES[5][2]), "All rights reserved.", "released UNDER the mit license", "Ünder the MIT License.", "word " * 20000 + "\nAll rights reserved.",
]


def plainly(text):
    numbers, ids = ls.numbered(ls.RULES), []
    for sentence in re.split(r"[.!?;]+(?:\s+|\Z)|\n+", (text or "").lower()):
        key = " ".join(re.sub("[^a-z0-9]+", " ", sentence).split())
        if key in numbers:
            ids.append(numbers[key])
    found = []
    for name, _, sentences in ls.RULES:
        rest = iter(ids)
        if all(numbers[ls.plain(s)] in rest for s in sentences):
            found.append((name, [numbers[ls.plain(s)] for s in sentences]))
    return ids, uncovered(found)


def uncovered(found):
    """Names of the matching rules that no longer matching rule holds whole."""

    def holds(longer, shorter):
        rest = iter(longer)
        return len(longer) > len(shorter) and all(n in rest for n in shorter)

    return sorted({name for name, ids in found if not any(holds(other, ids) for _, other in found)})


def tokens(text):
    """The parts of a text: words, and marks L (line end), S (closing) and " " (anything else)."""
    text, out, k = (text or "").lower(), [], 0
    plain = "abcdefghijklmnopqrstuvwxyz0123456789"
    while k < len(text):
        c, start = text[k], k
        if c in plain:
            while k < len(text) and text[k] in plain:
                k += 1
            out.append(text[start:k])
        elif c == "\n":
            k += 1
            while k < len(text) and text[k] not in plain + "\n":
                k += 1
            out.append("L")
        elif c in ".!?;":
            while k < len(text) and text[k] in ".!?;":
                k += 1
            closing = k == len(text) or text[k] in " \t\n\x0b\f\r"
            if closing or not out or out[-1] != " ":
                out.append("S" if closing else " ")
        else:
            k += 1
            if not out or out[-1] != " ":
                out.append(" ")
    return out


def wrapped(text):
    """Ids and licences by the rules of sentences that may run over lines, token by token."""
    numbers = ls.numbered(ls.ALL_RULES)
    known = sorted((s.split(), n) for s, n in numbers.items())
    known.sort(key=lambda x: len(" ".join(x[0])))
    parts, ids, k = tokens(text), [], 0

    def ends(at, words):
        for j, w in enumerate(words):
            if j:
                gap = at
                while at < len(parts) and parts[at] in (" ", "L"):
                    at += 1
                if parts[gap:at] not in ([" "], ["L"], [" ", "L"]):
                    return None
            if at >= len(parts) or parts[at] != w:
                return None
            at += 1
        after = at + (at < len(parts) and parts[at] == " ")
        return at if after == len(parts) or parts[after] in ("S", "L") else None

    while k < len(parts):
        if k == 0 or parts[k - 1] in ("S", "L"):
            at = k + (parts[k] == " ")
            hit = next(((n, e) for words, n in known if (e := ends(at, words)) is not None), None)
            if hit:
                ids.append(hit[0])
                k = hit[1]
                continue
        k += 1
    found = []
    for name, _, sentences in ls.ALL_RULES:
        wanted, rest = [numbers[ls.plain(s)] for s in sentences], iter(ids)
        if all(n in rest for n in wanted):
            found.append((name, wanted))
    return ids, uncovered(found)


def test_scan(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)] * 2, "doc_id long, text string, licenses string").repartition(3)
    got = ls.scan_licenses(docs).collect()
    assert len(got) == 2 * len(TEXTS)
    for r in got:
        assert (r.sentence_ids, r.licenses) == plainly(r.text), r.text
    assert [x for x in plainly(TEXTS[7])[1]] == ["MIT"] and plainly(TEXTS[6])[1] == []
    assert ls.scan_licenses(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = ls.scan_licenses(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


MIT_TEXT = """MIT License

Copyright (c) 2020 A. Author

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
BSD_2_TEXT = """Copyright (c) 2020, A. Author

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3_TEXT = BSD_2_TEXT + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL_TEXT = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
APACHE_TEXT = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""


OLD_GPL_TEXT = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
ONLY_TEXT = """This program is free software; you can redistribute it and/or modify it
under the terms of the GNU General Public License version 2 as published
by the Free Software Foundation.
"""
ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES.
"""
MPL_TEXT = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def test_wrapped_licences(spark):
    wanted = [(OLD_GPL_TEXT, ["LGPL-2.1-or-later"]), (ONLY_TEXT, ["GPL-2.0-only"]), (ISC_TEXT, ["ISC"]), (MPL_TEXT, ["MPL-2.0"])]
    wanted += [(MIT_TEXT, ["MIT"]), (BSD_2_TEXT, ["BSD-2-Clause"]), (BSD_3_TEXT, ["BSD-3-Clause"]), (GPL_TEXT, ["GPL-3.0-or-later"]), (APACHE_TEXT, ["Apache-2.0"])]
    rows = []
    for text, found in wanted:
        for prefix in ("", " * ", "// ", "# ", ";; ", "! ", "-- "):
            rows.append(("\n".join((prefix + line).rstrip() for line in text.split("\n")), found))
        rows.append((text.replace("\n", "\r\n"), found))
        rows.append(("/*\n" + text.replace("\n\n", "\n") + "*/ int main;", found))
    rows += [
        ("This work is licensed under a Creative Commons\nAttribution 4.0 International License.", ["CC-BY-4.0"]),
        ("About\nReleased under the MIT License\nand more", ["MIT"]),
        ("/* SPDX-License-Identifier: GPL-2.0-or-later */\nint x;", ["GPL-2.0-or-later"]),
        ("This is free and unencumbered software released into the public\ndomain.", ["Unlicense"]),
        ("Released under\n\nthe MIT License.", []),
        ("Released under.\nthe MIT License.", []),
        ("It was\nReleased under the MIT\nLicense of old.", []),
    ]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in ls.scan_licenses(docs).collect()}
    for k, (text, found) in enumerate(rows):
        assert got[k] == found, text


def test_texts_of_wrapped_sentences_in_any_order(spark):
    """Sentences of the rules, shuffled, repeated, wrapped and marked, against a reading token by token."""
    pick = random.Random(6)
    pool = [s for _, _, sentences in ls.ALL_RULES for s in sentences]
    texts = []
    for _ in range(300):
        out = []
        for _ in range(pick.randrange(1, 9)):
            words = pick.choice(pool + ls.RULES[5][2] * 8).split()
            if pick.random() < 0.2:
                words.insert(pick.randrange(len(words)), pick.choice(["more", "é", "--", "."]))
            prefix = pick.choice(["", " * ", "// ", "# "])
            line = "".join(w + (pick.choice([" ", " ", " ", "  ", "\n" + prefix, " \n" + prefix, ", "]) if pick.random() < 0.4 else " ") for w in words)
            out.append(pick.choice(["", prefix]) + (line.upper() if pick.random() < 0.2 else line).strip() + pick.choice([".", ".", "", "...", ";", " .", "!?"]))
        texts.append(pick.choice(["\n", " ", "\n\n", "\r\n"]).join(out))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in ls.scan_licenses(docs).collect():
        assert (r.sentence_ids, r.licenses) == wrapped(r.text), r.text


def test_long_texts_that_repeat_take_linear_time(spark):
    line = ls.RULES[5][2][0] + ".\n"
    docs = spark.createDataFrame([(0, line), (1, "."), (2, "; ")], "doc_id long, text string")
    docs = docs.withColumn("text", F.when(F.col("doc_id") == 0, F.concat(F.repeat("text", 100_000), F.lit(ls.RULES[5][2][1]))).when(F.col("doc_id") == 1, F.concat(F.repeat("text", 1_000_000), F.lit("license"))).otherwise(F.concat(F.repeat("text", 500_000), F.lit("a license"))))
    began = time.time()
    got = {r.doc_id: (r.n, r.licenses) for r in ls.scan_licenses(docs).select("doc_id", F.size("sentence_ids").alias("n"), "licenses").collect()}
    assert got == {0: (100_001, ["BSD-2-Clause"]), 1: (0, []), 2: (0, [])} and time.time() - began < 60


def test_every_sentence_has_a_tell_tale_word():
    words = ls.tell_tale_words(ls.ALL_RULES)
    assert all(any(w in s.split() for w in words) for s in ls.numbered(ls.ALL_RULES)) and len(words) < 12

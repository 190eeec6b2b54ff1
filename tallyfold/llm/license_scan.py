"""License scans by sentence rules, in DataFrame functions only.

A text is cut into sentences (at line ends and at closing marks before white
space or the end), each is normalised (lower case, every run of other characters
than a-z and 0-9 one space), and known licence sentences become their numbers.
A sentence may also run over several lines: a line end within it counts as a
space, with the marks that begin the next line (`` * ``, ``// ``, ``# ``, ``;; ``),
but a line without a-z or 0-9 ends it. Of the sentences that begin at a place the
shortest is taken, so that a notice on one line is found whatever follows it.
A licence rule is an ordered list of such sentences; it matches a text whose
sequence of numbers holds them in this order, with others between them or not. A
rule whose sentences are all in a longer rule that matches too is left out: the
text of BSD-3-Clause is not one of BSD-2-Clause as well.

Most texts hold none of the words that every known sentence has at least one of,
and are not searched further. All steps take time in proportion to a text's
length, and none recurses by it.

The table of sentences is part of the query's expressions, so it has to stay
within some hundreds of entries; nothing is shuffled.

Defined cases: a null or empty text has no sentences and no licence; texts are
read whole; repeated rows are judged alike; a comment's words at the beginning of
lines (``rem``, ``dnl``) are read as text; result columns replace input columns of
the same name.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, functions as F

# Licence identifier, category, and the sentences of each rule in order.
RULES: list[tuple[str, str, list[str]]] = [
    ("MIT", "permissive", ["Released under the MIT License"]),
    ("MIT", "permissive", ["Licensed under the MIT License"]),
    ("MIT", "permissive", ["This project is licensed under the MIT License"]),
    (
        "MIT",
        "permissive",
        [
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
        ],
    ),
    (
        "BSD-2-Clause",
        "permissive",
        [
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
        ],
    ),
    (
        "BSD-3-Clause",
        "permissive",
        [
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        ],
    ),
    ("Apache-2.0", "permissive", ["Licensed under the Apache License, Version 2.0"]),
    (
        "Apache-2.0",
        "permissive",
        [
            "Licensed under the Apache License, Version 2.0 (the \"License\")",
            "you may not use this file except in compliance with the License",
            "You may obtain a copy of the License at",
        ],
    ),
    ("GPL-3.0", "copyleft", ["This work is licensed under the GNU General Public License, version 3"]),
    (
        "GPL-3.0-or-later",
        "copyleft",
        [
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
        ],
    ),
    ("CC-BY-4.0", "attribution", ["Licensed under CC BY 4.0"]),
    ("CC-BY-SA-4.0", "copyleft", ["Licensed under CC BY-SA 4.0"]),
    ("CC-BY-NC-4.0", "noncommercial", ["Licensed under CC BY-NC 4.0"]),
    ("CC-BY-4.0", "attribution", ["This work is licensed under a Creative Commons Attribution 4.0 International License"]),
    ("CC0-1.0", "public domain", ["This work is dedicated to the public domain"]),
    ("all-rights-reserved", "proprietary", ["All rights reserved"]),
    (
        "ISC",
        "permissive",
        [
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
        ],
    ),
    ("MPL-2.0", "weak copyleft", ["This Source Code Form is subject to the terms of the Mozilla Public License, v"]),
    ("Unlicense", "public domain", ["This is free and unencumbered software released into the public domain"]),
    (
        "Zlib",
        "permissive",
        [
            "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
        ],
    ),
    ("CC-BY-SA-4.0", "copyleft", ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"]),
    ("CC-BY-NC-4.0", "noncommercial", ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"]),
]

# The family's names and versions, in the wording of the licences' own notices.
_FREE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version"
_ONLY = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, version {1} of the License"
_OLDER = "This {2} is free software; you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation; either version {1} of the License, or (at your option) any later version"
_OLD_ONLY = "This {2} is free software; you can redistribute it and/or modify it under the terms of the GNU {0} version {1} as published by the Free Software Foundation"
_FAMILY = [("GPL", "General Public License", ["2", "3"]), ("LGPL", "Lesser General Public License", ["2.1", "3"]), ("AGPL", "Affero General Public License", ["3"])]


def _family() -> list[tuple[str, str, list[str]]]:
    """Notices of the family with "only" and "or later", and its names in one line."""
    out = []
    for short, long, versions in _FAMILY:
        for v in versions:
            name = f"{short}-{v if '.' in v else v + '.0'}"
            for what in ("program", "library"):
                out.append((f"{name}-or-later", "copyleft", _OLDER.format(long, v, what).split("; ")))
                out.append((f"{name}-only", "copyleft", _OLD_ONLY.format(long, v, what).split("; ")))
            out.append((f"{name}-or-later", "copyleft", [_FREE.format(long, v)]))
            out.append((f"{name}-only", "copyleft", [_ONLY.format(long, v)]))
            out.append((name, "copyleft", [f"Licensed under the GNU {long}, version {v}"]))
    return out


#: Identifiers that a file's own line may state.
SPDX = [
    ("0BSD", "permissive"), ("AGPL-3.0-only", "copyleft"), ("AGPL-3.0-or-later", "copyleft"), ("Apache-2.0", "permissive"), ("BSD-2-Clause", "permissive"), ("BSD-3-Clause", "permissive"),
    ("BSL-1.0", "permissive"), ("CC-BY-4.0", "attribution"), ("CC-BY-SA-4.0", "copyleft"), ("CC0-1.0", "public domain"), ("EPL-2.0", "weak copyleft"), ("GPL-2.0-only", "copyleft"),
    ("GPL-2.0-or-later", "copyleft"), ("GPL-3.0-only", "copyleft"), ("GPL-3.0-or-later", "copyleft"), ("ISC", "permissive"), ("LGPL-2.1-only", "copyleft"), ("LGPL-2.1-or-later", "copyleft"),
    ("LGPL-3.0-only", "copyleft"), ("LGPL-3.0-or-later", "copyleft"), ("MIT", "permissive"), ("MPL-2.0", "weak copyleft"), ("Unlicense", "public domain"), ("Zlib", "permissive"),
]
RULES += _family()
RULES += [(name, kind, [f"SPDX-License-Identifier: {name}"]) for name, kind in SPDX]

#: Rules whose sentences end at a blank line; they have to come after ``RULES``, whose numbers stay.
PARAGRAPH_RULES: list[tuple[str, str, list[str]]] = [
    (
        "MIT",
        "permissive",
        [
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
        ],
    ),
]
ALL_RULES = RULES + PARAGRAPH_RULES

#: Where sentences of one line end; the same in Java's and RE2's syntax.
SENTENCE_END = r"[.!?;]+(?:\s+|\z)|\n+"
NOT_PLAIN = "[^a-z0-9]+"


def plain(sentence: str) -> str:
    """A sentence as the scan normalises it (for ASCII sentences)."""
    return " ".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in sentence.lower()).split())


def numbered(rules: list[tuple[str, str, list[str]]]) -> dict[str, int]:
    """Every sentence of the rules, normalised, with its number from 1."""
    out: dict[str, int] = {}
    for _, _, sentences in rules:
        for s in sentences:
            out.setdefault(plain(s), len(out) + 1)
    return out


def rule_patterns(rules: list[tuple[str, str, list[str]]]) -> list[tuple[str, str, str]]:
    """(licence, category, regular expression over ",n,n,n,") of each rule, for engines that match without backtracking."""
    numbers = numbered(rules)
    return [(name, kind, "," + "(?:[0-9]+,)*".join(f"{numbers[plain(s)]}," for s in sentences)) for name, kind, sentences in rules]


def covering(rules: list[tuple[str, str, list[str]]]) -> list[list[int]]:
    """For each rule the rules that hold all of its sentences, in order, and more."""
    numbers = numbered(rules)
    ids = [[numbers[plain(s)] for s in sentences] for _, _, sentences in rules]

    def within(a: list[int], b: list[int]) -> bool:
        rest = iter(b)
        return len(a) < len(b) and all(x in rest for x in a)

    return [[k for k, b in enumerate(ids) if within(a, b)] for a in ids]


def tell_tale_words(rules: list[tuple[str, str, list[str]]]) -> list[str]:
    """A few words, of which every sentence of the rules has one: each time the word that most of the rest have."""
    left, out = [set(s.split()) for s in numbered(rules)], []
    while left:
        counts: dict[str, int] = {}
        for words in left:
            for w in words:
                if len(w) > 4:
                    counts[w] = counts.get(w, 0) + 1
        if not counts:  # sentences of short words only
            out += [min(words) for words in left]
            break
        best = min(counts, key=lambda w: (-counts[w], w))
        out.append(best)
        left = [words for words in left if best not in words]
    return out


def sentence_numbers(text: Column, rules: list[tuple[str, str, list[str]]] = ALL_RULES) -> Column:
    """Numbers of the known sentences of a text, in order.

    In the lower-case text L stands for a line end and the marks after it, and S for closing marks.
    """
    table = F.create_map(*[F.lit(x) for item in numbered(rules).items() for x in item])
    lower = F.lower(F.coalesce(text, F.lit("")))
    marked = F.regexp_replace(lower, r"\n[^a-z0-9\n]*", "L")
    marked = F.regexp_replace(F.regexp_replace(marked, r"(?<![.!?;])[.!?;]++(?=[\sL]|\z)", "S"), "[^a-z0-9SL]+", " ")
    known = "|".join(s.replace(" ", "(?: L?|L)") for s in sorted(numbered(rules), key=len))
    found = F.regexp_extract_all(marked, F.lit(f"(?<![^SL]) ?({known})(?= ?(?:[SL]|\\z))"), F.lit(1))
    ids = F.transform(found, lambda s: F.element_at(table, F.regexp_replace(s, " ?L", " ")))
    may = functools.reduce(operator.or_, [F.contains(lower, F.lit(w)) for w in tell_tale_words(rules)])
    return F.when(may, ids).otherwise(F.array().cast("array<int>"))


def _matches(ids: Column, wanted: list[int]) -> Column:
    """Whether ids holds the wanted numbers in order: each is looked for after the place of the one before."""

    def after(at: Column, n: Column) -> Column:
        found = F.array_position(F.slice(ids, at + 1, F.size(ids)), n)
        return F.when((at < 0) | (found == 0), F.lit(-1)).otherwise(at + found.cast("int"))

    if len(wanted) == 1:
        return F.array_contains(ids, wanted[0])
    return F.aggregate(F.array(*[F.lit(n) for n in wanted]), F.lit(0), after) >= 0


def scan_licenses(docs: DataFrame, text_col: str = "text", rules: list[tuple[str, str, list[str]]] = ALL_RULES) -> DataFrame:
    """The documents with sentence_ids, licenses and categories (arrays; the last two sorted, without repeats)."""
    numbers, over = numbered(rules), covering(rules)
    marked = docs.withColumn("sentence_ids", sentence_numbers(F.col(text_col), rules))
    hits = F.array(*[_matches(F.col("sentence_ids"), [numbers[plain(s)] for s in sentences]) for _, _, sentences in rules])
    marked = marked.withColumn("__hits", F.when(F.size("sentence_ids") > 0, hits))
    hit = lambda k: F.col("__hits")[k]
    chosen = [functools.reduce(lambda c, o: c & ~hit(o), over[k], hit(k)) for k in range(len(rules))]

    def matched(which: int) -> Column:
        names = F.array(*[F.when(c, F.lit(r[which])) for c, r in zip(chosen, rules)])
        return F.when(F.size("sentence_ids") > 0, F.array_sort(F.array_distinct(F.array_compact(names)))).otherwise(F.array().cast("array<string>"))

    return marked.withColumns({"licenses": matched(0), "categories": matched(1)}).drop("__hits")


def scan_sql(rules: list[tuple[str, str, list[str]]] = RULES, table: str = "documents") -> str:
    """DuckDB SQL for doc_id, sentence_ids, n_sentences and licenses as strings."""
    cases = " ".join(f"WHEN '{s}' THEN {n}" for s, n in numbered(rules).items())
    patterns, over = [p for _, _, p in rule_patterns(rules)], covering(rules)
    wholly = lambda k: " AND ".join([f"regexp_matches(line, '{patterns[k]}')", *[f"NOT regexp_matches(line, '{patterns[o]}')" for o in over[k]]])
    hits = ", ".join(f"CASE WHEN {wholly(k)} THEN '{rules[k][0]}' END" for k in range(len(rules)))
    normal = f"trim(regexp_replace(s, '{NOT_PLAIN}', ' ', 'g'))"
    return f"""
        WITH numbers AS (
            SELECT doc_id, list_filter(list_transform(regexp_split_to_array(lower(coalesce(text, '')), '{SENTENCE_END}'),
                lambda s: CASE {normal} {cases} END), lambda n: n IS NOT NULL) AS ids
            FROM {table}
        ), lines AS (SELECT doc_id, ids, concat(',', array_to_string(ids, ','), ',') AS line FROM numbers)
        SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids, CAST(len(ids) AS BIGINT) AS n_sentences,
            coalesce(array_to_string(list_sort(list_distinct(list_filter([{hits}], lambda x: x IS NOT NULL))), '|'), '') AS licenses
        FROM lines
    """

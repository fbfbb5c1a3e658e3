"""License scans by patience alignment with known notices.

Words that occur once in a stretch of text and once in a template anchor the
alignment; the longest increasing run of anchors is kept, and the gaps between
them are aligned the same way, where words that were too frequent before may
have become unique. Coverage is the share of the template's words aligned.
What tells a license from its relatives, its name, variant and version, has to
be aligned without a word between.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_steps
from tillroll.llm.license_notices import PERMISSIVE, full_texts, headers, short_notices

WORD = re.compile(r"\w+")
LEAST = 0.8
# Before a name, these words make it another license.
QUALIFIERS = frozenset("custom modified non".split())
# Before a notice, and the verbs it may follow, these words refuse it; so does a verb with "n't".
REFUSALS = frozenset("not never nor neither without".split())
VERBS = frozenset(
    "is was are were has have had be been being made available released licensed distributed published provided isn wasn aren "
    "weren hasn haven hadn".split()
)
# A license expression; each identifier in it is one the text names.
EXPRESSION = re.compile(r"(SPDX-License-Identifier\s*:)([^\n]*)", re.I)
JOINS = re.compile(r"(?<=[\s)])(?:OR|AND)(?=[\s(])", re.I)

# Wording of common license notices, by SPDX identifier, and the phrases that decide.
NOTICES = (
    ("MIT", "Released under the MIT License.", ("MIT License",)),
    ("MIT", "Licensed under the MIT License.", ("MIT License",)),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", ("Apache License, Version 2.0",)),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
        ("Apache License, Version 2.0",),
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", ("GNU General Public License, version 3",)),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.",
        ("GNU General Public License", "version 3 of the License"),
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", ("GNU General Public License, version 2",)),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", ("CC BY-NC 4.0",)),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", ("CC BY 4.0",)),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", ("CC BY-SA 4.0",)),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ("Creative Commons Attribution 4.0",)),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission.",
        ("endorse or promote products",),
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("Mozilla Public License, v. 2.0",)),
    *short_notices(),
    *headers(),
    *PERMISSIVE,
    *full_texts(),
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, given in order of the first, that also increases in the second."""
    ends: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(ends, b)
        back.append(at[k - 1] if k else -1)
        if k == len(ends):
            ends.append(b)
            at.append(i)
        else:
            ends[k], at[k] = b, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned places (text, template): equal ends first, then unique anchors, then the gaps."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        once = unique_places(template, c, d)
        here = unique_places(text, a, b)
        anchors = increasing(sorted((p, once[w]) for w, p in here.items() if p >= 0 and once.get(w, -1) >= 0))
        if not anchors:
            continue
        out += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:], strict=False) if p + 1 < q and r + 1 < s]
    return sorted(out)


def unique_places(words: list[str], begin: int, end: int) -> dict[str, int]:
    """Place of each word between the two places; -1 if it occurs again."""
    out: dict[str, int] = {}
    for i in range(begin, end):
        out[words[i]] = -1 if words[i] in out else i
    return out


@dataclass(frozen=True)
class Templates:
    names: list[str]
    words: list[list[str]]
    # Where and how long the deciding phrases are, and the words they need.
    deciding: list[list[tuple[list[int], int]]]
    needed: list[frozenset[str]]
    distinct: list[frozenset[str]]
    pairs: dict[tuple[str, str], dict[int, list[int]]] = field(default_factory=dict)
    vocabulary: frozenset[str] = frozenset()


def templates_of(notices: tuple[tuple, ...]) -> Templates:
    """Templates of notices (license, text) or (license, text, deciding phrases)."""
    words = [words_of(n[1]) for n in notices]
    deciding, needed = [], []
    for row, (_, text, *given) in zip(words, notices, strict=True):
        phrases = [words_of(phrase) for phrase in (given[0] if given else ())]
        places = [[i for i in range(len(row)) if row[i : i + len(phrase)] == phrase] for phrase in phrases]
        if not all(places):
            raise ValueError(f"a deciding phrase isn't in its notice: {text[:80]}")
        deciding.append([(found, len(phrase)) for found, phrase in zip(places, phrases, strict=True)])
        needed.append(frozenset(w for phrase in phrases for w in phrase))
    pairs: dict[tuple[str, str], dict[int, list[int]]] = {}
    for k, row in enumerate(words):
        for i, pair in enumerate(zip(row, row[1:], strict=False)):
            pairs.setdefault(pair, {}).setdefault(k, []).append(i)
    distinct = [frozenset(row) for row in words]
    return Templates([n[0] for n in notices], words, deciding, needed, distinct, pairs, frozenset().union(*distinct))


def decided(words: list[str], aligned: list[tuple[int, int]], deciding: list[tuple[list[int], int]]) -> bool:
    """Whether each deciding phrase stands in the text once at least, as it is.

    ``aligned`` has places in ``words``. A qualifier before it or a further
    part of a version behind it, beyond the template, makes it another phrase.
    """
    place = {t: p for p, t in aligned}
    used = set(place.values())

    def stands(t: int, n: int) -> bool:
        p = place.get(t)
        if p is None or any(place.get(t + i) != p + i for i in range(n)):
            return False
        if p and p - 1 not in used and words[p - 1] in QUALIFIERS:
            return False
        after = words[p + n] if p + n < len(words) and p + n not in used else ""
        return not (words[p + n - 1].isdigit() and len(after) == 1 and after in "123456789")

    return all(any(stands(t, n) for t in places) for places, n in deciding)


def refused(words: list[str], first: int) -> bool:
    """Whether the words before a notice that begins at ``first`` say that it doesn't hold."""
    at = first
    while at and words[at - 1] in VERBS:
        at -= 1
    before = words[max(0, at - 2) : at]
    return bool(before) and (before[-1] in REFUSALS or (before[-1] == "t" and before[0] in VERBS))


def expanded(text: str) -> tuple[list[str], list[int]]:
    """The words of a text and their places in it; in a license expression each identifier has the tag before it."""
    words: list[str] = []
    places: list[int] = []

    def take(part: str) -> None:
        own = words_of(part)
        begin = places[-1] + 1 if places else 0
        words.extend(own)
        places.extend(range(begin, begin + len(own)))

    at = 0
    for found in EXPRESSION.finditer(text):
        take(text[at : found.end(1)])
        tag = slice(len(words) - 3, len(words))
        joins, begin = list(JOINS.finditer(found[2])), 0
        for join in joins:
            take(found[2][begin : join.end()])
            begin = join.end()
            words.extend(words[tag])
            places.extend([places[-1]] * 3)
        take(found[2][begin:])
        at = found.end()
    take(text[at:])
    return words, places


def scan(text: str, templates: Templates, least: float) -> list[tuple[str, int, float, int, int, int]]:
    """Matches (license, template, coverage, first word, last word, words aligned), not overlapping per template.

    Pairs of neighbouring words shared with a template vote for the place where
    it would begin; it is aligned at places with enough votes, most votes
    first, if the text holds its deciding words and enough of the others at all.
    """
    words, own = expanded(text)
    present = templates.vocabulary.intersection(words)
    may = {
        k for k, (row, needed) in enumerate(zip(templates.distinct, templates.needed, strict=True))
        if row and needed <= present and len(present) >= least * len(row) - 1e-9
        and len(row & present) >= least * len(row) - 1e-9
    }
    if not may:
        return []
    starts: dict[int, list[int]] = {}
    for p, pair in enumerate(zip(words, words[1:], strict=False)):
        given = templates.pairs.get(pair)
        if given:
            for k in may.intersection(given):
                starts.setdefault(k, []).extend(p - i for i in given[k])
    found = []
    for k, places in starts.items():
        template = templates.words[k]
        slack = max(4, len(template) // 4)
        places.sort()
        votes = Counter(places)
        # An alignment that covers enough keeps at least so many neighbours together.
        least_votes = (2 * least - 1) * len(template) - 2
        spans: list[tuple[int, int]] = []
        tried: set[int] = set()
        for s in sorted(votes, key=lambda s: (-votes[s], s)):
            if s in tried:
                continue
            if bisect_left(places, s + slack + 1) - bisect_left(places, s - slack) < least_votes:
                continue
            at = bisect_left(spans, (s, -1))
            begin = max(0, s - slack, spans[at - 1][1] + 1 if at else 0)
            end = min(s + len(template) + slack, spans[at][0] if at < len(spans) else len(words))
            tried.update(range(s - slack // 2, s + slack // 2 + 1))
            aligned = patience(words[begin:end], template) if begin < end else []
            coverage = len(aligned) / len(template)
            here = [(begin + p, t) for p, t in aligned] if coverage >= least else []
            if here and decided(words, here, templates.deciding[k]):
                first, last = here[0][0], here[-1][0]
                insort(spans, (first, last))
                if not (templates.deciding[k] and refused(words, first)):
                    found.append((templates.names[k], k, coverage, own[first], own[last], len(aligned)))
    return sorted(found, key=lambda f: (f[3], f[4], f[1]))


def best_matches(found: list[tuple]) -> list[tuple]:
    """Of overlapping matches the one with most words aligned stays, then the better covered, then the first."""
    kept: list[tuple] = []
    begins: list[int] = []
    for f in sorted(found, key=lambda f: (-f[5], -f[2], f[3], f[1])):
        at = bisect_left(begins, f[3])
        if (at == 0 or kept[at - 1][4] < f[3]) and (at == len(kept) or kept[at][3] > f[4]):
            begins.insert(at, f[3])
            kept.insert(at, f)
    return kept


def licenses(docs: DataFrame, notices: tuple[tuple, ...] = NOTICES, least: float = LEAST) -> DataFrame:
    """``doc_id, license, coverage, first_word, last_word, n_words`` for each notice found.

    Null texts are empty and hold none. Null and repeated ids keep their rows;
    other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(templates_of(notices))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_steps(batches):
            out = [
                (doc_id, name, coverage, first, last, n)
                for doc_id, raw in zip(batch.column("doc_id").to_pylist(), texts, strict=True)
                for name, _, coverage, first, last, n in best_matches(scan(raw.decode(), shared.value, least))
            ]
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*out, strict=True) if out else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "license", "coverage", "first_word", "last_word", "n_words"],
            )

    return rows.mapInArrow(
        step, "doc_id long, license string, coverage double, first_word long, last_word long, n_words long"
    )

"""Operators on single texts against plain computations."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import decontaminate, html_layout, language_id, license_align, lm_score, pii

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


PERSONAL = [
    "mail a.b@c.de, x@y, a@b.c_x@d.e and @z.q u@v.w.", "1.2.3.4 256.1.1.1 0255.0.0.1 1.2.3.4.5.6.7.8 99999.1.1.1",
    "card 4539 1488 0343 6467, 4539148803436467 and 4539-1488-0343-6468", "+49 (151) 123-45678 +1 2 +123456789012345678",
    "ü 中 😀 x@y.zz 😀 1.1.1.1 😀", "IBAN GB82 WEST 1234 5698 7654 32 or GB82WEST12345698765433", "ssn 123-45-6789, 123-45-6789 000-12-3456",
    "", None, "no personal data at all", "a" * 50000 + "@b.cc", "1 " * 40000, "1." * 30000, "+" + "1-" * 20000, "x@" * 20000,
    "+1 555 1234 5678 x@y.zz" * 700,
]


@pytest.fixture(scope="module")
def personal(spark):
    rows = [(i, t, "k") for i, t in enumerate(PERSONAL)] + [(None, "x@y.zz", "k"), (0, "x@y.zz", "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string")


def test_base_spans_and_added_ones(personal):
    rows = pii.pii_digest(personal).collect()
    assert len(rows) == len(PERSONAL) + 2
    for r in rows[: len(PERSONAL)]:
        want = base_spans(PERSONAL[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), r["doc_id"]
        counts = collections.Counter(k for k, _, _ in want)
        assert [r[f"n_{k}"] for k, _ in BASE] == [counts[k] for k, _ in BASE]
        assert r["spans"].startswith(joined) and len(r["scores"].split(",")) == max(1, len(r["spans"].split(",")))
    by_id = {r["doc_id"]: r["spans"] for r in rows[: len(PERSONAL)]}
    assert "iban:5:32" in by_id[5] and by_id[5].count("iban") == 1
    # Without a context word a social security number isn't reported.
    assert by_id[6] == "ssn:4:15"


@pytest.mark.filterwarnings("ignore")
def test_random_texts_have_the_base_spans(spark):
    rng = np.random.default_rng(0)
    parts = list("@.+- ()_a1") + ["4539148803436467", "a@b.c", "1.2.3.4", "+4915112345678", "é", "12"]
    texts = ["".join(rng.choice(parts, rng.integers(1, 30))) for _ in range(1500)]
    rows = pii.pii_digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), texts[r["doc_id"]]


def test_redaction_replaces_spans_only(personal):
    got = {r["doc_id"]: r for r in pii.redact(personal.filter("doc_id > 0")).collect()}
    assert got[4]["text"] == "ü 中 😀 [EMAIL] 😀 [IP] 😀"
    assert got[8]["text"] is None and got[9]["text"] == PERSONAL[9] and got[9]["spans"] == "k"
    for i in range(1, len(PERSONAL)):
        if PERSONAL[i]:
            covered, spans = "", sorted((a, -b, k) for k, a, b in base_spans(PERSONAL[i]))
            assert (got[i]["text"] == PERSONAL[i]) == (not spans and i not in (5, 6)), (i, covered)
    assert pii.redact(personal.limit(0)).columns == personal.columns


# --- html --------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("a<p>b<p>c</p>d", "a\n\nb\n\nc\n\nd"),
        ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "- a\n- b\n  3. x\n  4. y\n- c"),
        ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>", "a     bbb\ncccc  d"),
        ("<table><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>", "wide  z\na  b  c"),
        ("<table><tr><td rowspan=2>r<td>x<tr><td>y</table>", "r  x\n   y"),
        ("<pre>x\n  y</pre>z", "x\n  y\n\nz"), ("a<br>b<br><br>c", "a\nb\n\nc"), ("<b>a</b> <i>b</i>", "a b"),
        ("x<script>if (a < b) '</p>'</script>y<style>p{}</style>", "xy"), ("<div hidden>no<p>no</div>yes", "yes"),
        ("<p style='DISPLAY : none'>no</p>yes", "yes"), ("<!-- a <p> b -->x<!-- open", "x"), ("1 < 2 &amp; 3 &gt; 2", "1 < 2 & 3 > 2"),
        ("<head><title>t</title></head><body>b", "b"), ("<a href=\"x>y\">l</a>", "l"), ("</p></div>x", "x"),
        ("<img alt='pic'>", "pic"), ("<dl><dt>t<dd>d</dl>", "t\n  d"), ("<hr>", "---"), ("<td>x", "x"), ("<svg/>x", "x"),
        ("<div>" * 30000 + "deep", "deep"), ("<textarea></p>x</textarea>y", "</p>xy"), ("<blockquote>q</blockquote>e", "  q\n\ne"),
    ],
)
def test_rendering(html, text):
    assert html_layout.visible_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<head><title>T</title>Hello <p>x", "Hello\n\nx"), ("<head><title>T</title><em>a</em> b", "a b"),
        ("<head><title>T</title><font><p>whole page</font>", "whole page"), ("<head> <meta>\n<foo>bar</foo>", "bar"),
        ("<html><head>\n<title>T</title>\n<!-- c --> <style>p{}</style><script>s</script>\n<link></head><body>b", "b"),
        ("<head><noscript>n</noscript><template><b>t</b></template><svg/>x", "x"), ("<head><title>T</title></head><head>a", "a"),
        ("<head><![CDATA[c]]></head><body>b", "b"), ("<head></p><td>a", "a"), ("<head><textarea>t</textarea>v", "tv"),
    ],
)
def test_a_head_without_end_tag_ends_where_the_page_begins(html, text):
    assert html_layout.visible_text(html) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    "<p> </p> <table> <tr> <td> <th> </td> </tr> </table> <ul> <li> </ul> <ol> x <b> </b> <pre> </pre> <br> <div hidden> "
    "</div> <script> </script> < > & <!-- --> <td colspan=3 rowspan=2> <caption> </li> <select> <option> <dl> <dd> \n".split(" ")
), max_size=25))
def test_broken_markup_never_fails(parts):
    text = html_layout.visible_text("".join(parts))
    assert "<td" not in text and not text.startswith("\n")


def test_pages(spark):
    df = spark.createDataFrame([(1, "<p>a", "u"), (None, None, "u"), (1, "<p>a", "u")], "page_id long, html string, text string")
    got = sorted(str(tuple(r)) for r in html_layout.extract_text(df).collect())
    assert got == sorted(map(str, [(1, "a", 1, 1), (None, "", 0, 0), (1, "a", 1, 1)]))
    assert html_layout.extract_text(df.limit(0)).count() == 0


# --- licenses ------------------------------------------------------------------------


def test_patience_aligns_unique_words_then_gaps():
    text, template = "x a b a c d q".split(), "a b a c z d".split()
    assert license_align.patience(text, template) == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 5)]
    assert license_align.patience([], template) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), unique=True, max_size=12))
def test_longest_increasing_run(values):
    pairs = list(enumerate(values))
    got = license_align.increasing(pairs)
    best = [1] * len(values)
    for i in range(len(values)):
        best[i] += max([best[j] - 0 for j in range(i) if values[j] < values[i]], default=0)
    assert len(got) == max(best, default=0)
    assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:], strict=False))


def test_notices_are_found_where_they_stand(spark):
    mit = license_align.NOTICES[2][1]
    edited = mit.replace("free of charge", "at no charge").replace("distribute, ", "")
    rows = [
        (1, f"before {mit} after", 0), (2, edited, 0), (3, "Released under the MIT License. " * 3, 0), (4, "the license of the software", 0),
        (5, None, 0), (6, "", 0), (None, "Licensed under CC BY-NC 4.0.", 0), (7, "license the under released MIT " * 50, 0),
        (8, "w " * 30000 + license_align.NOTICES[4][1], 0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, license int")
    got = license_align.licenses(df).collect()
    found = collections.Counter((r["doc_id"], r["license"]) for r in got)
    assert found == {(1, "MIT"): 1, (2, "MIT"): 1, (3, "MIT"): 3, (None, "CC-BY-NC-4.0"): 1, (8, "Apache-2.0"): 1}
    whole = next(r for r in got if r["doc_id"] == 1)
    assert (whole["coverage"], whole["first_word"]) == (1.0, 1)
    assert 0.9 < next(r for r in got if r["doc_id"] == 2)["coverage"] < 1
    assert license_align.licenses(df.limit(0)).count() == 0


def licenses_in(text):
    templates = licenses_in.templates = getattr(licenses_in, "templates", None) or license_align.templates_of(license_align.NOTICES)
    return [f[0] for f in license_align.best_matches(license_align.scan(text, templates, license_align.LEAST))]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Released under the Apache License.", []),
        ("Released under the BSD License.", []),
        ("Released under the modified MIT License.", []),
        ("Released under MIT License.", ["MIT"]),
        ("Released under the terms of the MIT License.", ["MIT"]),
        ("Released under the BSD 2-Clause License.", ["BSD-2-Clause"]),
        ("This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
        ("Released under the GNU Lesser General Public License version 2.1.", ["LGPL-2.1"]),
        ("Licensed under the GNU General Public License v3.", ["GPL-3.0"]),
        ("Licensed under CC BY-ND 4.0.", ["CC-BY-ND-4.0"]),
        ("Licensed under CC BY-NC 3.0.", ["CC-BY-NC-3.0"]),
        ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
        ("Licensed under the Apache License, Version 1.1.", ["Apache-1.1"]),
        ("SPDX-License-Identifier: MIT", ["MIT"]),
        ("SPDX-License-Identifier: MIT-0", ["MIT-0"]),
        ("// SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0"]),
        (
            "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
            "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
            "any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
            "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
            "License for more details.", ["LGPL-2.1"],
        ),
    ],
)
def test_name_variant_and_version_decide(text, found):
    assert licenses_in(text) == found
    assert licenses_in(f"some words before. {text} And more words after it.") == found


def test_every_notice_is_found_as_its_license():
    for name, text, *_ in license_align.NOTICES:
        assert name in licenses_in(text), (name, text[:80])
        if len(text) < 300:
            assert licenses_in(text) == [name], text


def test_full_texts_and_relatives():
    by = {}
    for name, text, *_ in license_align.NOTICES:
        if len(text) > len(by.get(name, "")):
            by[name] = text
    for name in ("MIT", "MIT-0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "ISC", "0BSD", "Zlib", "GPL-2.0", "GPL-3.0", "Apache-2.0"):
        assert licenses_in(f"Copyright 2020 A. {by[name]} End")[0] == name
    # The body of a relative is not taken for the license itself.
    affero = by["GPL-3.0"].replace("GNU GENERAL", "GNU AFFERO GENERAL").replace("GNU General", "GNU Affero General")
    assert "GPL-3.0" not in licenses_in(affero)


# --- language ---------------------------------------------------------------------------


def test_phrases_are_those_of_the_greedy_parse():
    samples = {"x": "abab acab", "y": "bcbcbc"}
    points = {k: np.array([0 if c == " " else ord(c) for c in v], "u4") for k, v in samples.items()}
    known = language_id.learn(points)
    mapping = known.symbol_map()
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abc zé1"), rng.integers(0, 1500))) for _ in range(30)] + ["", "ééé", "ABAB"]
    rows = [language_id.normal_symbols(t.encode(), mapping) for t in texts]
    at = {c: i for i, c in enumerate(known.symbols, 1)}
    coded = {k: [at.get(int(c), 0) for c in points[k]] for k in known.names}

    def parse(row, sample):
        sample = "".join(map(chr, sample))
        n = 0
        for begin in range(0, len(row), language_id.SEGMENT):
            part = "".join(map(chr, row[begin : begin + language_id.SEGMENT].tolist()))
            i = 0
            while i < len(part):
                j = i + 1
                while j <= len(part) and part[i:j] in sample:
                    j += 1
                i, n = max(i + 1, j - 1), n + 1
        return n

    want = [[parse(r, coded[k]) for k in known.names] for r in rows]
    assert language_id.count_phrases(rows, known).tolist() == want


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_undetermined_texts(spark):
    rows = [(1, "some words of english text", "en", 0), (2, None, "en", 0), (3, "123 !?", None, 0), (4, "", "de", 0), (5, "deutsche wörter", "de", 0),
            (6, "english words", None, 0), (None, "words of text", "en", 0), (6, "english words", None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = language_id.language_digest(df).collect()
    assert len(got) == 8
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {2, 3, 4}
    kept = language_id.reject_undetermined(df)
    assert kept.columns == df.columns
    assert sorted((str(r["doc_id"]), r["lang"]) for r in kept.collect()) == [
        ("1", "en"), ("5", "de"), ("6", "en"), ("6", "en"), ("None", "en")]
    assert {r["lang_pred"] for r in language_id.language_digest(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.language_digest(df.limit(0)).count() == 0


# --- decontamination -----------------------------------------------------------------------


def plain_alignment(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            s = 2 if a[i] == b[j] else -1
            table[i + 1, j + 1] = max(0, table[i, j] + s, table[i, j + 1] - 1, table[i + 1, j] - 1)
    return table.max()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=15), st.lists(st.integers(0, 4), min_size=1, max_size=20))
def test_alignment_score(a, b):
    score, first, last, matches = decontaminate.align(np.array(a, "u4"), np.array(b, "u4"))
    assert score == plain_alignment(a, b)
    if score:
        assert 0 <= first <= last < len(b) and 2 * matches >= score


def test_copies_are_caught_and_clean_documents_left(spark):
    items = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").limit(40).collect()]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    all_items = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    clean = [r["text"] for r in docs.collect() if not any(t in r["text"] for t in all_items)][:300]
    rng = np.random.default_rng(0)
    rows = [(i, t) for i, t in enumerate(clean)]
    for i, t in enumerate(items):
        words = t.split()
        for k in rng.choice(len(words), max(1, len(words) // 10), replace=False):
            words[k] = "changed"
        rows.append((1000 + i, f"{clean[i]} {t} {clean[i + 1]}"))
        rows.append((2000 + i, f"{clean[i + 2]} {' '.join(words).upper()} {clean[i + 3]}"))
    rows += [(3000, None), (None, items[0]), (3001, ""), (3002, items[1]), (3002, items[1])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, score int")
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)] + [(99, None, "x"), (98, "", "x"), (None, "a b c", "x")],
                                  "item_id long, text string, doc_id string")
    got = decontaminate.contaminated(df, bench).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    want = {(1000 + i, i) for i in range(40)} | {(2000 + i, i) for i in range(40)} | {(None, 0), (3002, 1)}
    assert pairs == want
    kept = decontaminate.without_copies(df, bench)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(300), 3000, 3001]
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0
    assert decontaminate.without_copies(df.limit(0), bench).count() == 0


def test_seeds_do_not_lengthen_with_the_corpus():
    # Two words of share 1 in 10,000 and two common ones, in turns.
    shares = np.array([0.0, 1e-4, 1e-4, 0.01, 0.02])
    row = np.array([1, 2, 3, 4] * 3, "u4")
    small, large = (decontaminate.seeds_of([row], shares, total) for total in (10**6, 10**10))
    assert {n: v[2].tolist() for n, v in small.items()} == {n: v[2].tolist() for n, v in large.items()}
    assert 2 in large


def test_items_of_common_words_are_found(spark):
    # Every word has a share of 1 in 4, so that no run of up to eight words is rare.
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcd"), 400)) for _ in range(50)]
    item = "a a b b c c d d a c b d a d c b a a c c"
    docs = [(i, t) for i, t in enumerate(texts)] + [(99, f"c d {item} a b")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    shares = np.array([0.0, *[0.25] * 4])
    words = np.array(["abcd".index(w) + 1 for w in item.split()], "u4")
    assert [len(v[0]) for v in decontaminate.seeds_of([words], shares, 10**10).values()] == [1]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert any(r["doc_id"] == 99 and r["score"] == 1.0 for r in got)


# --- language model ---------------------------------------------------------------------------


def slow_ctw(train, text, depth):
    """Context-tree weighting by recursion over dictionaries, counts as trained."""
    counts = collections.defaultdict(lambda: [0, 0])
    children = collections.defaultdict(set)

    def bits(raw):
        padded = b"\0" * depth + raw
        for i in range(depth, len(padded)):
            for b in range(8):
                yield padded[i - depth : i][::-1], 1 << b | padded[i] >> (8 - b), padded[i] >> (7 - b) & 1

    for raw in train:
        for context, node, bit in bits(raw):
            for d in range(depth + 1):
                counts[context[:d], node][bit] += 1
                if d:
                    children[context[: d - 1], node].add(context[:d])

    def kt(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1) - math.log(math.pi)

    memo = {}

    def weighted(context, node):
        if (context, node) not in memo:
            own = kt(*counts[context, node])
            if len(context) < depth:
                below = sum(weighted(c, node) for c in children[context, node])
                own = np.logaddexp(own, below) - math.log(2)
            memo[context, node] = own
        return memo[context, node]

    total = 0.0
    for context, node, bit in bits(text):
        p = 0.5
        for d in range(depth, -1, -1):
            c = context[:d]
            if (c, node) not in counts:
                continue
            z = counts[c, node]
            share = 1.0 if d == depth else math.exp(kt(*z) - math.log(2) - weighted(c, node))
            p = share * (z[bit] + 0.5) / (sum(z) + 1) + (1 - share) * p
        total += math.log10(p)
    return total


LM_TEXTS = [
    (1, "the cat sat on the mat"), (2, "the cat ate the rat. The END"), (3, None), (4, ""), (5, "été à la mer"), (6, "zzz qqq the"),
    (7, "the the the cat"), (8, "on the mat sat a cat"), (9, "a rat"), (10, "a cat \x00\x01"), (None, "no id, held out"), (7, "the the the cat"),
    (11, "mat " * 3000), (21, "unseen wörds only"), (30, "cat"), (33, "rat"),
]


def test_scores_match_their_definitions(spark, tmp_path):
    rows = [(i, t, 0.0) for i, t in LM_TEXTS]
    spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    import zlib

    out = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    assert {out(i) for i, _ in LM_TEXTS} == {True, False}
    train = [(t or "").encode() for i, t in LM_TEXTS if not out(i)]
    words = collections.Counter(w for t in train for w in t.lower().split())
    n, v = sum(words.values()) + len(train), len(words) + 1
    got = lm_score.score_documents(df).collect()
    assert len(got) == len(LM_TEXTS)
    want = collections.defaultdict(list)
    for i, t in LM_TEXTS:
        raw = (t or "").encode()
        found = raw.lower().split()
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in found)
        base += math.log10((len(train) + 0.1) / (n + 0.1 * (v + 1)))
        want[i].append((out(i), len(found) + 1, sum(w in words for w in found) + 1, n, base, slow_ctw(train, raw, lm_score.DEPTH)))
    for r in got:
        w = want[r["doc_id"]].pop()
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4]) and r["score"] == pytest.approx(w[5])
    assert lm_score.score_documents(df.limit(0)).count() == 0


def test_probabilities_of_a_byte_add_up():
    raw = b"abracadabra, abracadabra!" * 4
    key, n = np.unique(lm_score.grams_of(raw, 2), return_counts=True)
    levels = lm_score.subtree(key, n, 2, 0)
    for context in (0, 97 | 98 << 8, 120 | 121 << 8):
        every = np.arange(256) | context << 8
        assert (10 ** lm_score.gram_logs(every, levels, 2)).sum() == pytest.approx(1)


def test_joined_grams_are_those_of_each_text():
    texts = [b"abcdefgh", b"", b"xy", b"\0\0z"]
    want = np.concatenate([lm_score.grams_of(t) for t in texts])
    assert lm_score.joined_grams(texts).tolist() == want.tolist()


def test_packed_grams_come_back():
    key = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 1000))
    assert lm_score.unpack_keys(lm_score.pack_keys(key)).tolist() == key.tolist()
    assert lm_score.unpack_keys(lm_score.pack_keys(key[:0])).tolist() == []
    values = np.log(key + 1.0)
    assert lm_score.unpack(lm_score.pack(values), "f8").tolist() == values.tolist()
    assert (lm_score.group_of(key, 7) == lm_score.group_of(key | 255 << 40 | 255, 7)).all()


def test_five_bytes_of_context_count(spark, tmp_path):
    # The byte after four equal ones depends on the fifth before.
    train = "1abcdx 2abcdy " * 200
    rows = [(1, train), (30, "1abcdx"), (30, "1abcdy")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    got = lm_score.score_documents(spark.read.parquet(str(tmp_path / "d"))).collect()
    right, wrong = sorted((r["score"] for r in got if r["doc_id"] == 30), reverse=True)
    assert right - wrong > 1.5


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 3.25, 100.5, 1e6])
    assert lm_score.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-12)


def test_parts_of_a_group_give_the_same_scores(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice(["the", "cat", "sat", "on", "mats", "again"], rng.integers(1, 60)))) for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "4k")
    try:
        whole = {r["doc_id"]: r["score"] for r in lm_score.score_documents(df).collect()}
        monkeypatch.setattr(lm_score, "PART_BYTES", 60)
        parts = {r["doc_id"]: r["score"] for r in lm_score.score_documents(df).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert parts == pytest.approx(whole)


def test_other_texts_of_the_same_number_are_noticed():
    marks = {lm_score.text_mark(t, o) for t, o in (([b"a", b"b"], [True, False]), ([b"a", b"c"], [True, False]), ([b"a", b"b"], [False, True]))}
    assert len(marks) == 3


@pytest.mark.parametrize(("changed", "least"), [(0.1, 1.0), (0.2, 0.95), (0.3, 0.8)])
def test_recall_of_edited_copies(spark, changed, least):
    """Copies of 50-word passages with a share of their words replaced, one in each of many documents."""
    rng = np.random.default_rng(int(changed * 100))
    words = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l")]
    passage = lambda n: rng.choice(words, n).tolist()
    items = [passage(50) for _ in range(60)]
    docs = []
    for i, item in enumerate(items):
        copy = [w if rng.random() >= changed else rng.choice(words) for w in item]
        docs.append((i, " ".join(passage(200) + copy + passage(100))))
    docs += [(1000 + i, " ".join(passage(350))) for i in range(200)]
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, benchmark).collect()}
    recall = sum((i, i) in found for i in range(len(items))) / len(items)
    assert recall >= least, recall
    assert not any(d >= 1000 for d, _ in found)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<textarea>\nab\n c &amp; d</textarea>x", "ab\n c & dx"), ("<input value='typed'><input type=checkbox value=no>", "typed"),
        ("<input type=hidden value=h><input type=password value=p>y", "y"),
        ("<select><option>a<option selected>b</select> z", "b z"), ("<select><option>a</option><option>b</select>", "a"),
        ("<select multiple><option>a<option>b</select>", "a\nb"), ("<select><optgroup label=l><option>a</select>", "a"),
        ("<svg><title>t</title><text>drawn</text><path/></svg> <math><mi>x</mi><annotation>no</annotation></math>", "drawn x"),
        ("<p style='visibility:hidden'>no <b style='Visibility : visible'>yes</b> no</p>", "yes"),
        ("<p style='display:none'>no <b style='visibility:visible'>no</b></p>y", "y"),
        ("<ul style='visibility:collapse'><li>no<li style='visibility:visible'>yes</ul>", "- yes"),
        ("<ol reversed><li>a<li>b<ul><li>c</ul><li>d</ol>", "3. a\n2. b\n   - c\n1. d"),
        ("<ol reversed start=9><li>a<li value=4>b<li>c</ol>", "9. a\n4. b\n3. c"),
        ("<ol type=a start=26><li>a<li>b</ol>", "z. a\naa. b"), ("<ol type=I start=1994><li>a</ol>", "MCMXCIV. a"),
        ("<ol start=-1><li>a<li>b<li>c</ol>", "-1. a\n0. b\n1. c"), ("<ol type=i start=0><li>a</ol>", "0. a"),
        ("<table><tr><td colspan=400>a<td>b<tr><td>c</table>", "ab\nc"),
    ],
)
def test_more_of_what_is_visible(html, text):
    assert html_layout.visible_text(html).replace("a  b", "ab") == text


def slow_is_open(page, names, limits):
    for name, *_ in reversed(page.open):
        if name in names:
            return True
        if name in limits:
            return False
    return False


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("<p> </p> <div> </div> <table> <tr> <td> </table> <li> <ul> </ul> <i> </td> <svg> <option> <select> x".split()), max_size=60))
def test_places_of_open_elements_against_a_walk(tags):
    page = html_layout.Page()
    for what, name, rest in html_layout.tokens("".join(tags)):
        getattr(page, {"text": "text", "start": "start", "end": "end"}[what])(*((rest,) if what == "text" else (name, rest, False) if what == "start" else (name,)))
        for names, limits in (({"p"}, html_layout.SCOPE), ({"td", "th"}, {"tr", "table"}), ({"tr"}, {"table"}), ({"li"}, {"ul", "ol"})):
            assert page.is_open(names, limits) == slow_is_open(page, names, limits)
        assert sum(map(len, page.at.values())) == len(page.open)


@pytest.mark.parametrize("tag", ["<div>", "<i></p>", "<b>", "<ul><li>", "<p><em>", "<svg><g>"])
def test_deep_pages_cost_as_much_per_tag_as_flat_ones(tag):
    import time

    def seconds(n):
        begin = time.perf_counter()
        html_layout.visible_text(tag * n + "deep")
        return time.perf_counter() - begin

    assert min(seconds(40000) for _ in range(2)) < 12 * min(seconds(10000) for _ in range(2)) + 0.2


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("SPDX-License-Identifier: Apache-2.0 OR MIT", ["Apache-2.0", "MIT"]),
        ("SPDX-License-Identifier: (GPL-2.0-or-later AND BSD-3-Clause) OR MIT\nor not", ["GPL-2.0", "BSD-3-Clause", "MIT"]),
        ("SPDX-License-Identifier: ISC\nMIT and more", ["ISC"]),
        ("It is not released under the MIT License.", []), ("This isn't licensed under the MIT License", []),
        ("It has never been made available, licensed under the MIT License", []),
        ("It is not only free, it is released under the MIT License.", ["MIT"]),
        ("Licensed under GPLv3", ["GPL-3.0"]), ("released under the LGPL v2.1", ["LGPL-2.1"]), ("GPL-2.0-or-later", ["GPL-2.0"]),
        ("GNU Affero General Public License, version 3", ["AGPL-3.0"]),
    ],
)
def test_expressions_refusals_and_abbreviations(text, names):
    found = license_align.best_matches(license_align.scan(text, license_align.templates_of(license_align.NOTICES), 0.8))
    assert [f[0] for f in found] == names
    words = license_align.words_of(text)
    assert all(0 <= f[3] <= f[4] < len(words) for f in found)


def test_context_words_are_whole_words():
    import re

    for kind in pii.KINDS:
        pattern = re.compile(pii.context_words(kind))
        if kind.name == "ip":
            assert pattern.search("my ip is") and not pattern.search("a trip to")
        if kind.name == "phone":
            assert pattern.search("tel 12") and not pattern.search("hotel 12")


def test_blocks_of_items_find_what_one_block_finds(spark, monkeypatch):
    items = [f"item {i} has words{i} of its{i} own and some{i} more that{i} are rare" for i in range(12)] + ["", None]
    docs = [(i, "before " + t + " after it") for i, t in enumerate(items) if t] + [(99, "nothing of them here")]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    whole = sorted(map(tuple, decontaminate.contaminated(table, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    passes = []
    count = decontaminate.word_shares
    monkeypatch.setattr(decontaminate, "word_shares", lambda *a: passes.append(1) or count(*a))
    assert sorted(map(tuple, decontaminate.contaminated(table, benchmark).collect())) == whole
    assert len(passes) == 1 and {r[0] for r in whole} == set(range(12))
    assert decontaminate.without_copies(table, benchmark).count() == 1

"""Packed counters against filters applied one by one in every order."""

import collections
import random
import re
from itertools import permutations

import duckdb
import pytest

from tillroll.llm import filter_audit
from tillroll.llm.common import on_workers

SF = "/root/testdata/sf0.001"


def fails_of(text, earlier):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    conditions = (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text)), earlier,
    )
    return {n for n, c in zip("ABCDE", conditions) if c}


def by_hand(docs, labels):
    first, told = {}, collections.defaultdict(lambda: [False, False])
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, quality, toxic in labels:
        if i is not None:
            told[i] = [told[i][0] or quality == 1, told[i][1] or toxic == 1]
    rows = [
        (lang or "", fails_of(text or "", i is not None and i > first[text or ""]), *(told[i] if i in told else (False, False)))
        for i, text, lang in docs
    ]
    out, shapley = {}, collections.Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, name in enumerate(order, 1):
                lost = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                redundant = sum(name in r[1] for r in gone)
                alone = sum(r[1] == {name} for r in rows if r[0] == part)
                out[part, order, step] = (len(left), len(lost), redundant, alone, sum(r[2] for r in lost), sum(r[3] for r in lost))
                shapley[part, name] += len(lost)
                gone += lost
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def counts(df):
    rows = df.collect()
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def tables(spark):
    on_workers(spark)
    rng = random.Random(2)
    texts = [None, "", " ", "A" * 40, "a\x0bb\tc", "a\xa0b", "LOUD % text", "#", "Éa" * 30, " ".join(["same"] * 300), " ".join(map(str, range(300)))]
    docs = [(rng.choice([None, *range(30)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(160)]
    docs.append((99, " ".join(f"w{i}" for i in range(60000)), "en"))
    labels = [(rng.choice([None, *range(40)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    d = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in docs], "doc_id long, text string, lang string, part string, n int, mask int, `a.b` string")
    l = spark.createDataFrame([(*r, 1, "z") for r in labels], "doc_id long, quality int, toxic int, n int, `a.b` string")
    return docs, labels, d.repartition(4), l


def test_counts_by_hand(tables):
    docs, labels, d, l = tables
    got = counts(filter_audit.audit_digest(d, l))
    want = by_hand(docs, labels)
    assert len(got) == 3 * 600
    assert got == want


def test_sums_of_few_parts_at_a_time(tables, monkeypatch):
    _, _, d, l = tables
    before = counts(filter_audit.audit_digest(d, l))
    monkeypatch.setattr(filter_audit, "HELD", 1)
    assert counts(filter_audit.audit_digest(d, l)) == before


def test_fields_do_not_overflow(spark):
    rows = spark.createDataFrame([("a", 3, (1 << 52) + i) for i in range(50)] + [("a", 0, 1)], "part string, kind int, n long")
    total = 50 * (1 << 52) + 49 * 25
    got = counts(filter_audit.audit(rows.repartition(5), "ABC"))
    assert len(got) == 6 * 3
    assert got["a", "ABC", 1] == (1, total, 0, 0, 0, 0, 3 * total)
    assert got["a", "ABC", 2] == (1, 0, total, 0, 0, 0, 3 * total)
    assert got["a", "CAB", 1] == (total + 1, 0, 0, 0, 0, 0, 0)


def test_empty_tables(tables):
    _, _, d, l = tables
    assert filter_audit.audit_digest(d.limit(0), l).count() == 0
    got = counts(filter_audit.audit_digest(d, l.limit(0)))
    assert len(got) == 3 * 600 and all(v[4] == v[5] == 0 for v in got.values())


def test_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(filter_audit.digest_sql())
    names = [c[0] for c in cursor.description]
    got = filter_audit.audit_digest(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")))
    assert sorted(map(tuple, got.select(names).collect())) == sorted(cursor.fetchall())

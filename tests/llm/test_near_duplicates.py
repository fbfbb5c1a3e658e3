"""Near-duplicate operators against brute force."""

import collections
import itertools
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillroll.llm import embedding_dedup, simhash
from tillroll.llm.common import shuffle_partitions
from tillroll.llm.components import connected_components


def closure(n, links):
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(3)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(200, i) for i in range(201, 260)]
    edges = chain + star + [tuple(e) for e in rng.integers(300, 400, (60, 2)).tolist()] + [(5, 5)]
    got = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    want = closure(400, [e for e in edges if e[0] != e[1]])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {i: want[i] for i in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text, words=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)]
    if len(found) < words:
        shingles = [" ".join(found)] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [
    "one two three four five six", "One TWO three\tfour\nfive  six", "only three words", "", None, " É x y z w",
    "a b c d " * 400, "a b c d " * 400 + "e",
]


def test_fingerprints_match_their_definition(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in simhash.fingerprints(df).collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(TEXTS)}
    assert simhash.fingerprints_of([], 4).tolist() == []


def fingerprints_with_groups():
    """Random ones, clusters around some, and many that share a 20-bit part."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 400, dtype="u8")
    near = []
    for b in base[:60].tolist():
        for k in (1, 3, 4, 5, 6):
            near.append(b ^ sum(1 << int(i) for i in rng.choice(64, k, replace=False)))
    crowd = (rng.integers(0, 1 << 44, 300, dtype="u8") << np.uint64(20)) | np.uint64(0xABCDE)
    return np.unique(np.concatenate([base, np.array(near, "u8"), crowd, np.zeros(1, "u8")]))


@pytest.mark.parametrize("distance", [0, 1, 4, 7])
def test_links_are_those_of_all_pairs(spark, distance):
    fp = fingerprints_with_groups()
    df = spark.createDataFrame([(int(v),) for v in fp.view("i8")], "fp long")
    found = simhash.fingerprint_links(df, distance).collect()
    place = {int(v): i for i, v in enumerate(fp.view("i8"))}
    got = closure(len(fp), [(place[r["a"]], place[r["b"]]) for r in found])
    pairs = np.argwhere(np.triu(np.bitwise_count(fp[:, None] ^ fp[None]) <= distance, 1))
    assert got == closure(len(fp), pairs.tolist())


def test_crowded_values_are_met_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    fp = fingerprints_with_groups()
    probing = simhash.Probing(
        [list(range(i * 16, i * 16 + 16)) for i in range(4)],
        [np.bincount(((fp >> np.uint64(16 * i)) & np.uint64(65535)).astype(int), minlength=65536) for i in range(4)], 4,
    )
    rows = [b.to_pandas() for b in simhash.meeting_rows(fp, probing, 1)]
    import pandas as pd

    links = simhash.verified_links(pd.concat(rows), 4)
    place = {int(v): i for i, v in enumerate(fp.view("i8"))}
    got = closure(len(fp), [(place[a], place[b]) for a, b in links.itertuples(index=False)])
    pairs = np.argwhere(np.triu(np.bitwise_count(fp[:, None] ^ fp[None]) <= 4, 1))
    assert got == closure(len(fp), pairs.tolist())


def test_allocation_is_the_cheapest_split():
    rng = np.random.default_rng(1)
    costs = [np.cumsum(np.vstack([np.zeros(20), rng.random((5, 20))]), axis=0) for _ in range(3)]
    picked = simhash.allocate(costs, 5)
    assert (picked.sum(axis=0) == 5).all()
    for j in range(20):
        got = sum(costs[i][picked[i, j], j] for i in range(3))
        best = min(
            sum(costs[i][t[i], j] for i in range(3)) for t in itertools.product(range(6), repeat=3) if sum(t) == 5
        )
        assert got == pytest.approx(best)


def test_ball_counts():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 5, 64)
    got = simhash.ball_counts(counts, 6, 3)
    near = np.bitwise_count(np.arange(64, dtype="u8")[:, None] ^ np.arange(64, dtype="u8")[None])
    for d in range(4):
        assert got[d].tolist() == pytest.approx(((near <= d) * counts).sum(1).tolist())


def test_groups_and_what_stays(spark):
    rows = [
        (9, "one two three four five six", "x"), (4, "One TWO three four five six", "x"), (None, "one two three four five six", "x"),
        (7, "", "y"), (8, None, "y"), (None, "nameless text of its own here", "z"), (None, "nameless text of its own here", "z"),
        (11, "quite another text with words of its own", "w"), (11, "quite another text with words of its own", "w"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.simhash_digest(df).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == sorted(
        [("9", "4"), ("4", "4"), ("None", "4"), ("7", "7"), ("8", "7"), ("None", "None"), ("None", "None"),
         ("11", "11"), ("11", "11")]
    )
    assert {r["fingerprint"] for r in got if r["doc_id"] in (7, 8)} == {"0" * 16}
    kept = simhash.one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((str(r["doc_id"]), r["fp"]) for r in kept.collect()) == [("11", "w"), ("4", "x"), ("7", "y"), ("None", "z")]
    assert simhash.simhash_digest(df.limit(0)).count() == 0
    assert simhash.one_per_group(df.limit(0)).count() == 0


def vectors(seed=0, dim=24, n=900):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, n, 6):
        x[i + 1] = x[i] + rng.normal(size=dim) * 0.02
        x[i + 2] = x[i]
        x[i + 3] = x[i] * 3.5 + rng.normal(size=dim) * 0.1
    crowd = rng.normal(size=dim)
    x[-200:] = crowd + rng.normal(size=(200, dim)) * 0.12
    return x.astype("f4"), rng.integers(0, 3, n)


def brute(x, labels, least):
    x = x.astype("f8")
    near = (x @ x.T) / np.sqrt((x**2).sum(1)[:, None] * (x**2).sum(1)[None]) >= least
    near &= labels[:, None] == labels[None]
    np.fill_diagonal(near, False)
    return near


def test_vectors_against_all_pairs(spark):
    x, labels = vectors()
    rows = [(i, x[i].tolist(), int(labels[i])) for i in range(len(x))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    near = brute(x, labels, 0.98)
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(df).collect()}
    links = sum(r["n_links"] for r in got.values())
    assert links <= near.sum() and links >= 0.99 * near.sum()
    exact = {r["vec_id"]: r for r in embedding_dedup.near_vectors(df, slack=1.0).collect()}
    assert [exact[i]["n_links"] for i in range(len(x))] == near.sum(1).tolist()
    want = closure(len(x), np.argwhere(np.triu(near)).tolist())
    assert [exact[i]["component_id"] for i in range(len(x))] == want
    assert all(exact[i]["kept"] == (want[i] == i) for i in range(len(x)))


def test_crowded_lists_are_split(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 11)
    x, labels = vectors(seed=4, n=400)
    df = spark.createDataFrame([(i, x[i].tolist(), int(labels[i])) for i in range(len(x))],
                               "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(df, slack=1.0).collect()}
    assert [got[i] for i in range(len(x))] == brute(x, labels, 0.98).sum(1).tolist()


def test_odd_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [
        (1, one, 0, "a"), (2, one, 0, "b"), (3, one, None, "c"), (4, one, 1, "d"), (5, None, 0, "e"), (6, [0.0, 0.0, 0.0], 0, "f"),
        (7, [float("nan"), 1.0, 0.0], 0, "g"), (8, [float("inf"), 1.0, 0.0], 0, "h"), (9, [None, 1.0, 0.0], 0, "i"),
        (10, [1.0, 0.0], 0, "j"), (11, [], 0, "k"), (2, one, 0, "l"), (None, one, 0, "m"), (12, [1e-30, 0.0, 0.0], 0, "n"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cid string")
    got = [tuple(r) for r in embedding_dedup.near_vectors(df).orderBy("vec_id").collect()]
    first = [(None, 4, 1, False), (1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False)]
    rest = [(i, 0, i, True) for i in range(3, 12)]
    assert got == [*first, *rest, (12, 4, 1, False)]
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0
    assert shuffle_partitions(spark) == 8 and F is not None


@pytest.mark.parametrize("turn", [1, -1])
def test_a_repeated_id_does_not_lose_a_text(spark, turn):
    a, b = "one text of several words that go on", "another text with quite different words altogether"
    rows = [(3, a, 1), (5, a, 2), (5, b, 3), (5, b, 4), (None, b, 5), (None, "words of no other row at all here", 6)]
    df = spark.createDataFrame(rows[::turn], "doc_id long, text string, n int").coalesce(1)
    kept = sorted((r["doc_id"] or 0, r["text"], r["n"]) for r in simhash.one_per_group(df).collect())
    assert [(i, t) for i, t, _ in kept] == [(0, rows[5][1]), (3, a), (5, b)]
    again = spark.createDataFrame(rows, df.schema).repartition(4)
    assert kept == sorted((r["doc_id"] or 0, r["text"], r["n"]) for r in simhash.one_per_group(again).collect())


def test_probers_of_a_rare_value_are_met_in_blocks(spark, monkeypatch):
    """Thousands of fingerprints of one part value probe its rare neighbour, and no meeting holds them all."""
    monkeypatch.setattr(simhash, "BLOCK", 200)
    rng = np.random.default_rng(4)
    crowd = (rng.integers(0, 1 << 32, 4000, dtype="u8") << np.uint64(32)) | np.uint64(0xABCD1234)
    rare = np.concatenate([crowd[:3] ^ np.uint64(1), crowd[3:6] ^ np.uint64(1 << 40)])
    fp = np.unique(np.concatenate([crowd, rare, rng.integers(0, 1 << 63, 500, dtype="u8")]))
    prints = spark.createDataFrame([(int(x),) for x in fp.view("i8")], "fp long")
    probing = simhash.with_probes(prints, simhash.probing_of(prints, 2))
    rows = [b.to_pandas() for b in simhash.meeting_rows(fp, probing, 1)]
    sizes = collections.Counter(m for b in rows for m in b["meeting"])
    assert max(sizes.values()) < 3 * 200 < 4000
    near = np.bitwise_count(fp[:, None] ^ fp[None]) <= 2
    label = np.arange(len(fp))
    for _ in range(8):
        label = np.array([label[row].min() for row in near])
    links = simhash.fingerprint_links(prints, 2).toPandas()
    at = {int(x): i for i, x in enumerate(fp.view("i8"))}
    found = list(range(len(fp)))
    for _ in range(12):
        for a, b in zip(links["a"], links["b"], strict=True):
            low = min(found[at[a]], found[at[b]])
            found[at[a]] = found[at[b]] = low
    assert found == label.tolist()

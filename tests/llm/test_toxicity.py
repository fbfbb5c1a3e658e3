"""Sentences, the noisy-or fit and what it finds in planted documents."""

import math
import random

import numpy as np
import pytest

from tillroll.llm import toxicity
from tillroll.llm.common import on_workers

CALM = "river stone garden window paper letter morning silver basket candle forest bridge".split()
FOUL = "scoundrel wretch vermin".split()
SF = "/root/testdata/sf0.1"


def planted(n, seed, share=0.3):
    """Texts of several calm sentences; toxic ones hold foul words in one of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        sentences = [[rng.choice(CALM) for _ in range(rng.randint(3, 9))] for _ in range(rng.randint(1, 8))]
        at = None
        if rng.random() < share:
            at = rng.randrange(len(sentences))
            sentences[at][rng.randrange(len(sentences[at]))] = rng.choice(FOUL)
        before = sum(len(" ".join(s)) + 2 for s in sentences[:at]) if at is not None else None
        place = (before, before + len(" ".join(sentences[at]))) if at is not None else None
        rows.append((i, ". ".join(" ".join(s) for s in sentences), int(at is not None), place))
    return rows


@pytest.fixture(scope="module")
def found(spark):
    on_workers(spark)
    rows = planted(900, 5)
    docs = spark.createDataFrame([(i, t, "x", 0.5, 1) for i, t, _, _ in rows], "doc_id long, text string, lang string, score double, h int")
    labels = spark.createDataFrame([(i, 0, y) for i, _, y, _ in rows], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity_digest(docs.repartition(4), labels).collect()}
    return rows, got, docs, labels


def test_held_out_documents_are_told_apart(found):
    rows, got, _, _ = found
    assert len(got) == len(rows)
    unseen = [(got[i], y) for i, _, y, _ in rows if got[i]["held_out"]]
    assert len(unseen) > 100
    assert sum(r["predicted"] == y for r, y in unseen) >= 0.97 * len(unseen)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_offending_sentences_are_located(found):
    rows, got, _, _ = found
    toxic = [(got[i], place) for i, _, y, place in rows if y and got[i]["predicted"]]
    assert sum((r["worst_start"], r["worst_end"]) == place for r, place in toxic) >= 0.97 * len(toxic)


def test_only_labels_kept_for_learning_count(found):
    rows, got, docs, labels = found
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1 - labels.toxic).otherwise(labels.toxic))
    again = toxicity.toxicity_digest(docs.withColumn("lang", toxicity.F.lit("other")), flipped.repartition(3))
    assert {r["doc_id"]: r["score"] for r in again.collect()} == {i: r["score"] for i, r in got.items()}


def test_odd_rows(spark, found):
    _, _, docs, labels = found
    odd = [(None, "wretch", "c"), (7000, None, "c"), (7001, "", "c"), (7002, "123 ...", "c"), (7003, "vermin", "c"), (7003, "vermin", "c"),
           (7004, "calm river. " * 60000 + "wretch stone vermin", "c"), (7005, "é́" * 50000, "c")]
    kind = "doc_id long, text string, `a.b` string"
    rows = spark.createDataFrame(odd, kind).unionByName(docs.select("doc_id", "text", docs.lang.alias("a.b")))
    twice = labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 1, 1), (3, 1, None)], labels.schema))
    got = {}
    for r in toxicity.toxicity_digest(rows, twice).filter("doc_id is null or doc_id >= 7000").collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [got[i][0]["score"] for i in (7000, 7001, 7002)] == [0, 0, 0]
    assert len(got[7003]) == 2 and got[7003][0] == got[7003][1] and got[7003][0]["predicted"] == 1
    assert got[None][0]["held_out"] and got[None][0]["predicted"] == 1
    assert got[7004][0]["predicted"] == 1 and got[7004][0]["worst_start"] == 12 * 60000
    assert toxicity.toxicity_digest(docs, labels.limit(0)).agg({"score": "max"}).first()[0] < 1e-20
    assert toxicity.toxicity_digest(docs.limit(0), labels).count() == 0
    clean = toxicity.toxicity_digest(docs, labels.filter("toxic = 0"))
    assert clean.filter("predicted = 1").count() == 0


def test_sentences_against_a_plain_split():
    texts = ["Ab cd! ef. Gh\n\nij", "", "...", "İx straße. " + "w " * 70 + "end", "a" * 5000 + " b"]
    found = toxicity.sentences_of([t.encode() for t in texts])
    cut = [(int(o), texts[o][a:b]) for o, a, b in zip(found.owner, found.start, found.end, strict=True)]
    long = ["w " * 31 + "w", "w " * 31 + "w", "w " * 6 + "end"]
    assert cut == [(0, "Ab cd"), (0, "ef"), (0, "Gh"), (0, "ij"), (3, "İx straße"), *((3, x) for x in long), (4, texts[4])]


def test_features_do_not_depend_on_the_other_words():
    words = ["idiot", "idiotic", "supercalifragilistic" * 3, "on", "x" * 500, "Idiot"]
    alone = [toxicity.sentences_of([w.encode()]).features[0] for w in words]
    together = toxicity.sentences_of([" ".join(words + ["a"] * 1000).encode()]).features
    assert np.array_equal(np.array(alone), together[: len(words)])
    assert np.array_equal(alone[0], alone[-1]) and alone[0][0] != alone[1][0]
    assert alone[0][2] == alone[1][2]


def test_parts_of_long_texts_change_nothing(monkeypatch):
    rows = [t.encode() for _, t, _, _ in planted(40, 9)] + [b"", "été. Où".encode() * 30]
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(0, 0.5, 1 << toxicity.BITS).astype("f4"), -1.0)
    whole = toxicity.judge_texts(rows, model)
    monkeypatch.setattr(toxicity, "LONG", 20)
    parts = toxicity.judge_texts(rows, model)
    assert np.allclose(whole[0], parts[0], atol=1e-9) and whole[1].tolist() == parts[1].tolist()
    places = lambda x: [[(p["start"], p["end"]) for p in row] for row in x[2]]
    assert places(whole) == places(parts)


def test_noisy_or_by_hand():
    model = toxicity.Model(np.zeros(1 << toxicity.BITS, "f4"), -1.0)
    p = 1 / (1 + math.exp(1.0))
    score, count, _ = toxicity.judge_texts([b"a. b. c", b"a"], model)
    assert np.allclose(score, [1 - (1 - p) ** 3, p]) and count.tolist() == [3, 1]


def test_accuracy_on_the_held_out_tenth(spark):
    """The held-out fifth of the given labels; many toxic texts there are in languages with few examples."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity_digest(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(toxic) >= 0.7 * len(toxic) and sum(clean) <= 0.02 * len(clean)

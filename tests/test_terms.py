"""Colour groups through the term index against a plain search."""

import math
import random
import re

from pyspark.sql import functions as F

from tillroll.functions.columns import title_case
from tillroll.functions.palette import PALETTE
from tillroll.operators import terms

ENTRIES = [(group, term.lower()) for group, listed in PALETTE for term in listed]
LETTERS = "abcdefghijklmnopqrstuvwxyz &+-/é【"


def fewest_edits(value, term):
    """Least edits that make ``value`` a stretch of ``term``."""
    row = [0] * (len(term) + 1)
    for i, c in enumerate(value, 1):
        new = [i] + [0] * len(term)
        for j, d in enumerate(term, 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d))
        row = new
    return min(row)


def plain_group(value, prefer, entries=ENTRIES):
    """None where the text itself is the group."""
    edits = math.ceil(len(value) * 0.1)
    equal = [g for g, t in entries if t == value]
    if equal:
        return equal[0]
    held = [(i, g, t) for i, (g, t) in enumerate(entries) if t in value]
    if held:
        return (min(held, key=lambda x: (-len(x[2]), x[0])) if prefer == "closest" else held[0])[1]
    near = [
        (i, g, t) for i, (g, t) in enumerate(entries)
        if len(value) <= edits or (len(t) >= len(value) - edits and fewest_edits(value, t) <= edits)
    ]
    if not near:
        return None
    if prefer == "closest":
        return min(near, key=lambda x: (abs(len(x[2]) - len(value)), x[0]))[1]
    return ([x for x in near if x[1] == "default"] or near)[0][1]


def edited(rng, n):
    out = set()
    while len(out) < n:
        term = rng.choice(ENTRIES)[1]
        if rng.random() < 0.2:
            letters = [rng.choice(LETTERS) for _ in range(rng.randint(1, 14))]
        else:
            begin = rng.randrange(len(term))
            letters = list(term if rng.random() < 0.3 else term[begin : rng.randint(begin + 1, len(term))])
            for _ in range(rng.randint(0, max(1, len(letters) // 7))):
                at, how = rng.randrange(len(letters) + 1), rng.random()
                letters[at : at + (how < 0.67)] = [rng.choice(LETTERS)] * (how > 0.33)
        text = " ".join("".join(letters).lower().split())
        if text:
            out.add(text)
    return sorted(out)


def groups(spark, texts, index):
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    found = terms.text_groups(df, index, "g").join(df.withColumn("own", title_case(F.col("text"))), "text")
    rows = found.collect()
    assert len(rows) == len(texts)
    return {r["text"]: (r["g"], r["own"]) for r in rows}


def test_groups_are_those_of_a_plain_search(spark):
    texts = edited(random.Random(4), 1500)
    for prefer in ("listed", "closest"):
        got = groups(spark, texts, terms.term_index(spark, prefer=prefer))
        for t in texts:
            want = plain_group(t, prefer)
            assert got[t][0] == (got[t][1] if want is None else want), (t, prefer)


def test_a_palette_from_a_table(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(3, 24))) for _ in range(400)]
    entries = [(f"g{i % 7}", w) for i, w in enumerate(words)]
    palette = spark.createDataFrame([(i, g, t.upper()) for i, (g, t) in enumerate(entries)], "ord int, name string, term string")
    texts = sorted({w[rng.randint(0, 2) :] + rng.choice("abcde") for w in words} | {"a", "ab", "bcdea" * 9})
    index = terms.term_index(spark, palette)
    got = groups(spark, texts, index)
    for t in texts:
        want = plain_group(t, "listed", entries)
        assert got[t][0] == (got[t][1] if want is None else want), t
    df = spark.createDataFrame([(1, texts[5]), (2, None), (3, "  ")], "id int, color string")
    rows = {r["id"]: r["color_group"] for r in terms.classify_terms(df, "color", index).collect()}
    assert rows == {1: got[texts[5]][0], 2: None, 3: None}


def test_no_terms(spark):
    palette = spark.createDataFrame([], "ord int, name string, term string")
    df = spark.createDataFrame([("pale moon",)], "color string")
    assert terms.classify_terms(df, "color", palette).first()["color_group"] == "Pale Moon"


def test_a_million_texts_meet_the_index_by_equal_keys(spark):
    texts = spark.range(1_000_000).select(F.concat(F.lit("shade "), F.col("id").cast("string")).alias("text"))
    index = terms.term_index(spark)
    plan = terms.text_groups(texts, index)._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"(\w+Join|CartesianProduct)\b", plan)
    assert joins and set(joins) <= {"BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin"}
    assert "key#" in plan and "exists(" not in plan and "lambda" not in plan.split("Generate")[0]


def test_frequent_texts(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "navy blue").otherwise(F.concat(F.lit("tone "), F.col("id"))).alias("color"))
    got = terms.classify_terms(df, "color").groupBy("color_group").count().orderBy(F.desc("count")).first()
    assert tuple(got) == ("Blue", 1000)

"""The stages one after the other, each held against its own input."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillroll.llm import decontaminate, pii, queries, simhash
from tillroll.llm.common import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(900001, None, None, None, None), (None, "mail x@y.zz of somebody", "en", "s", 23), (900002, "123 456", "en", "s", 7),
         (900003, "call +49 151 12345678 or 1.2.3.4 now my friends", "en", "s", 47)],
        docs.schema,
    )
    out = [docs.unionByName(odd)]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name))
    return out


def test_columns_stay(steps):
    for table in steps[:-1]:
        assert table.columns == steps[0].columns


def test_only_undetermined_documents_are_rejected(steps):
    before, after = ({r["doc_id"] for r in t.collect()} for t in steps[:2])
    assert before - after == {900001, 900002}


def test_one_document_of_each_group_stays(steps):
    texts = {r["doc_id"]: r["text"] for r in steps[1].collect()}
    ids = [i for i in texts if i is not None]
    fp = simhash.fingerprints_of([texts[i].encode() for i in ids], 4)
    near = np.bitwise_count(fp[:, None] ^ fp[None]) <= 4
    label = np.array(ids)
    for _ in range(len(ids)):
        label, old = np.array([label[row].min() for row in near]), label
        if (label == old).all():
            break
    kept = {r["doc_id"] for r in steps[2].collect()}
    assert kept == {i for i, c in zip(ids, label.tolist(), strict=True) if i == c} | {None}


def test_documents_with_test_items_go(spark, steps):
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r["doc_id"]: r["text"] for r in steps[2].collect()}
    after = {r["doc_id"] for r in steps[3].collect()}
    assert {i for i, t in before.items() if any(x in t for x in items)} <= set(before) - after
    assert after and len(before) - len(after) < len(before) / 4


def test_personal_data_is_gone_and_the_rest_untouched(steps):
    before = {r["doc_id"]: r for r in steps[3].collect()}
    spans = {r["doc_id"]: r["spans"] for r in pii.pii_digest(steps[3]).collect()}
    after = {r["doc_id"]: r for r in steps[4].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert (r["text"] == before[i]["text"]) == (spans[i] == "")
        assert r["n_chars"] == len(r["text"])
    assert after[900003]["text"] == "call [PHONE] or [IP] now my friends"
    assert all(r["n_email"] == r["n_ip"] == r["n_card"] == r["n_phone"] == 0 for r in pii.pii_digest(steps[4]).collect())


def test_everything_is_packed(steps):
    got = steps[5].collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in steps[4].collect()}
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends.get(r["sequence_id"], 0) == r["offset"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096


def test_no_documents(spark, steps):
    docs = steps[0].limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.count() == 0


CLASHES = "_pred _share _fp component_fp _exact a.b row id h bare tie exact lang_pred score doc fp component_id _row".split()


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_names_of_other_columns_do_not_matter(spark, stage):
    """Each stage gives the rows it gives without them, each with its own values."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHES])
    name, run = stage
    plain, wide = run(spark, docs, SF), run(spark, more, SF)
    assert wide.columns == more.columns
    rows = wide.collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(map(tuple, plain.collect()))
    assert all(tuple(r)[5:] == tuple(f"{c} {r['doc_id']}" for c in CLASHES) for r in rows)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_personal_data_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(queries.oracle_sql()["op5_pii"])
    names = [d[0] for d in want.description]
    rows = sorted(map(tuple, want.fetchall()))
    got = queries.queries()["op5_pii"](spark, SF).select(*names)
    assert sorted(map(tuple, got.collect())) == rows


@pytest.mark.parametrize("name", [n for n in queries.queries() if n != "op5_pii"])
def test_every_query_runs(spark, name):
    assert queries.queries()[name](spark, SF).count() >= 0
    assert decontaminate.WORD

"""Chunked encoding, record files and packing against plain tokenizers."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillroll.llm import packing, token_records
from tillroll.llm.tokens import ChunkEncoder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    (1, "Two  words,\n\n and \t more.  "), (2, None), (None, "no id"), (3, ""), (3, "same id"), (3, "same id"),
    (5, "a<|endoftext|>b \x1c c"), (4, "Straße É ǅ 中文    é ΑΣ"), (6, "word. " * 9000), (7, "x" * 30000),
]


def plain(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "extra", 1) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, rank string, part int").repartition(3)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("abzABZ019 .,!?'\n\t ́éßΣ中\x1c<|>")), max_size=40))
def test_chunks_give_the_ids_of_the_whole_text(text):
    for path, lower in ((BYTE, False), (WORD, True)):
        got = np.frombuffer(ENCODERS[path].encode([text.encode()])[0], "<u4").tolist()
        assert got == TOKENIZERS[path].encode(text, add_special_tokens=False).ids


ENCODERS = {BYTE: ChunkEncoder(BYTE, False), WORD: ChunkEncoder(WORD, True)}
TOKENIZERS = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


def test_forgetting_changes_nothing():
    encoder = ChunkEncoder(WORD, True, places=8)
    texts = [b"some longer words and some short ones, some words"] * 3 + [b"others here, and these too; or not"]
    whole = [np.array(encoder.ids(t), "<u4").tobytes() for t in texts]
    for _ in range(4):
        assert [encoder.encode([t])[0] for t in texts] == whole


@pytest.mark.parametrize("lower", [False, True])
def test_long_texts_are_cut_at_white_space(lower):
    rng = np.random.default_rng(0)
    parts = ["word", "Other,", " ", "\n\n", "\t", "x" * 90, "été", "a.b", "it's", "12"]
    text = " ".join(rng.choice(parts, 300_000)).encode()
    encoder = ENCODERS[WORD if lower else BYTE]
    assert encoder.encode([b"", text, b" ", b"ab"]) == [
        np.array(encoder.ids(t), "<u4").tobytes() for t in (b"", text, b" ", b"ab")
    ]


def test_records_hold_every_document_in_order(spark, docs, tmp_path):
    manifest = token_records.write_records(docs, BYTE, f"file://{tmp_path}/rec")
    got = token_records.read_records(manifest).orderBy("start").collect()
    want = collections.Counter()
    for i, t in ODD:
        ids = np.array([*plain(BYTE, t), 0], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    rows = {r["shard"]: r for r in manifest.collect()}
    some = got[len(got) // 2]
    shard = rows[some["shard"]]
    doc_id, ids = token_records.read_record(shard["records"], shard["index"], some["position"])
    assert (doc_id, zlib.crc32(ids.tobytes())) == (some["doc_id"], some["ids_crc32"])


def test_a_damaged_record_is_noticed():
    raw = token_records.frame(token_records.payload_of(9, np.array([1, 70000], "<u4"), False))
    assert token_records.sequence_of(token_records.unframe(raw))[1].tolist() == [1, 70000]
    for at in (0, 9, 14, len(raw) - 1):
        broken = bytearray(raw)
        broken[at] ^= 1
        with pytest.raises((ValueError, Exception)):
            token_records.unframe(bytes(broken))


def test_no_documents(docs):
    nothing = docs.limit(0)
    assert token_records.records_digest(nothing, BYTE).count() == 0
    assert packing.pack_documents(nothing, WORD).count() == 0


def test_packing_places_every_piece_once(docs):
    got = packing.pack_documents(docs, WORD, capacity=64).collect()
    want = collections.Counter()
    for i, t in ODD:
        ids = np.array([*plain(WORD, t), 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want[i, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    check_places([(r["sequence_id"], r["offset"], r["length"]) for r in got], 64)


def check_places(rows, capacity):
    bins = collections.defaultdict(list)
    for sequence, offset, length in rows:
        bins[sequence].append((offset, length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def bins_of(histogram, capacity):
    """Bins of a plan, after checking that every piece has a place of its own without gaps."""
    plan = packing.plan_bins(histogram, capacity)
    rows = []
    for length, count in histogram.items():
        own = plan[plan[:, 0] == length]
        for rank in range(count):
            _, lo, each, first, offset = own[np.searchsorted(own[:, 1], rank, "right") - 1]
            rows.append((first + (rank - lo) // each, offset + (rank - lo) % each * length, length))
    return check_places(rows, capacity)


def fewest_large_bins(histogram, capacity):
    """Fewest bins that pieces above a third need: at most two share one, so as many pairs as fit are formed."""
    large = sorted(n for n, c in histogram.items() if 3 * n > capacity for _ in range(c))
    pairs, low, high = 0, 0, len(large) - 1
    while low < high:
        if large[low] + large[high] <= capacity:
            pairs, low = pairs + 1, low + 1
        high -= 1
    return len(large) - pairs


def fewest_bins(sizes, capacity):
    """Optimum by trying every place for each piece, largest first."""
    best = len(sizes)

    def place(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(sizes):
            best = len(room)
            return
        for at in {r: k for k, r in enumerate(room) if r >= sizes[i]}.values():
            place(i + 1, [r - sizes[i] * (k == at) for k, r in enumerate(room)])
        place(i + 1, [*room, capacity - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@example({1: 1, 21: 11, 40: 9})
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 50), max_size=40))
def test_plans_are_gapless_and_close_to_the_bound(histogram):
    total = sum(n * c for n, c in histogram.items())
    least = max(fewest_large_bins(histogram, 60), -(-total // 60))
    assert bins_of(histogram, 60) <= least * 11 / 9 + 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=9))
def test_plans_of_few_pieces_against_every_packing(sizes):
    best = fewest_bins(sizes, 30)
    got = bins_of(dict(collections.Counter(sizes)), 30)
    assert best <= got <= best + (best > 2)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(21, 60), st.integers(1, 30), max_size=30))
def test_plans_of_large_pieces_are_the_best_there_are(histogram):
    assert bins_of(histogram, 60) == fewest_large_bins(histogram, 60)


def test_keys_of_chunks_are_dealt_evenly(spark):
    from pyspark.sql import functions as F

    from tillroll.llm.common import spread_keys

    for count in (1, 5, 8, 100):
        rows = spread_keys(spark, count).collect()
        assert sorted(r["chunk"] for r in rows) == list(range(count)) and len({r["key"] for r in rows}) == count
    dealt = spread_keys(spark, 24).repartition(8, "key").groupBy(F.spark_partition_id()).count().collect()
    assert [r["count"] for r in dealt] == [3] * 8


def test_stored_tables_are_released(spark, monkeypatch):
    import os

    from tillroll.llm import common

    monkeypatch.setattr(common, "_stored", {})
    df = common.stored(spark.range(10), "some")
    paths = next(iter(common._stored.values()))
    assert df.count() == 10 and os.path.isdir(paths[0])
    assert common.release(spark) == 1 and not os.path.exists(paths[0])
    assert common.release(spark) == 0

"""Alignment of two tokenizers against a walk over sets of byte offsets."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tillroll.llm import token_alignment
from tillroll.llm.common import on_workers

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BYTES, PIECES = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
BYTES.encode_special_tokens = True
LETTERS = token_alignment.byte_letters()
ODD = [
    (1, "Two  words,\n\n and \t more.  "), (2, None), (None, "no id"), (3, ""), (3, "same id"), (3, "same id"), (3, "same id"),
    (5, "a<|endoftext|>b <s></s><unk> <0x41> \x00 \x1c c"), (4, "Straße É ǅ 中文    é ΑΣ 😀"), (6, "holds ▁ its own mark"),
    (7, "word. " * 9000), (8, "x" * 30000), (9, "line;\r\nnext \r line"), (10, " leading"), (11, "\n"), (12, "▁"),
]


def plain(text):
    """Both rows of ids and their bytes, from whole texts."""
    if not text:
        return [], [], [], []
    a, b = BYTES.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    spelled = [bytes(LETTERS[c] for c in BYTES.id_to_token(i)) for i in a]
    pieces = [PIECES.id_to_piece(i) for i in b]
    other = [bytes([int(p[3:5], 16)]) if PIECES.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
    if b"".join(spelled) != (" " + text).encode() or b"".join(other) != (" " + text).encode():
        return [], [], [], []
    return a, b, spelled, other


def groups_of(text):
    a, b, spelled, other = plain(text)
    ends_a, ends_b = (np.cumsum([len(x) for x in s]).tolist() for s in (spelled, other))
    common = sorted(set(ends_a) & set(ends_b))
    place_a, place_b = ({e: i + 1 for i, e in enumerate(ends)} for ends in (ends_a, ends_b))
    out, i, j = [], 0, 0
    for e in common:
        out.append((a[i : place_a[e]], b[j : place_b[e]]))
        i, j = place_a[e], place_b[e]
    return a, b, out


def wanted(rows):
    linked = collections.Counter()
    for _, text in rows:
        linked.update((x[-1], y[-1]) for x, y in groups_of(text)[2])
    most = {}
    for (_, y), n in linked.items():
        most[y] = max(n, most.get(y, 0))
    out = collections.Counter()
    for doc_id, text in rows:
        a, b, groups = groups_of(text)
        links = [(x[-1], y[-1]) for x, y in groups]
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        best = sum(linked[p] == most[p[1]] for p in links)
        out[doc_id, len(a), len(b), len(groups), len(links), best, sum(linked[p] for p in links), digest] += 1
    return out


def digests(df):
    return collections.Counter(tuple(r) for r in token_alignment.alignment_digest(df, A, B).collect())


@pytest.fixture(scope="module")
def docs(spark):
    on_workers(spark)
    rows = [(i, t, "extra", 1, 2, "c") for i, t in ODD]
    kind = "doc_id long, text string, pair string, n int, chunk int, `a.b` string"
    return spark.createDataFrame(rows, kind).repartition(3)


def test_digests_against_whole_texts(docs):
    assert digests(docs) == wanted(ODD)


def test_small_chunks_give_the_same_counts(docs, monkeypatch):
    rows = docs.select("doc_id", "text")
    before = digests(rows)
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", 1)
    assert digests(rows) == before


def test_many_rows_of_one_text(spark):
    rows = [(i, "the same words, again and again" if i % 3 else f"number {i} unlike others") for i in range(400)]
    assert digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == wanted(rows)


def test_no_documents(docs):
    assert digests(docs.limit(0)) == {}


def test_groups_are_returned_as_arrays(docs):
    rows = token_alignment.aligned(docs, A, B, ["doc_id"]).collect()
    got = collections.Counter()
    for r in rows:
        i = j = 0
        groups = []
        for x, y in zip(r["a_upto"], r["b_upto"], strict=True):
            groups.append((tuple(r["a_ids"][i:x]), tuple(r["b_ids"][j:y])))
            i, j = x, y
        got[r["doc_id"], tuple(groups)] += 1
    assert got == collections.Counter((i, tuple((tuple(x), tuple(y)) for x, y in groups_of(t)[2])) for i, t in ODD)


PAIR = token_alignment.tokenizer_pair(A, B)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("abzTHe019 .,;!'\n\t\r▁<s>éß中")), max_size=40))
def test_ids_are_those_of_the_whole_text(text):
    [(a, b)] = PAIR.encode([text.encode()])
    assert (a.tolist(), b.tolist()) == tuple(plain(text)[:2])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.lists(st.integers(1, 4), max_size=60))
def test_stretches_cover_both_rows(one, two):
    short, long = sorted((one, two), key=sum)
    if sum(long) > sum(short):
        short = [*short, sum(long) - sum(short)]
    ends_a, ends_b = np.cumsum(short, dtype="u4"), np.cumsum(long, dtype="u4")
    uneven = token_alignment.align(ends_a, ends_b)
    i = j = 0
    for a, a_end, b, b_end in [*uneven, (len(ends_a), len(ends_a), len(ends_b), len(ends_b))]:
        assert ends_a[i:a].tolist() == ends_b[j:b].tolist()
        i, j = a_end, b_end
    a, a_end, b, b_end = np.array(uneven, "i8").reshape(-1, 4).T
    common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    for ends, begin, end in ((ends_a, a, a_end), (ends_b, b, b_end)):
        assert ends[token_alignment.last_tokens(len(ends), begin, end)].tolist() == common

"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A seed is the shortest run of words from a place in a test item that chance
would rarely produce at a place of a text: the product of the words' shares in
the corpus stays below ``RATE``, which is the same for every corpus, so a copy
that is found in a small one is found in a large one too. What chance does
produce is refused by the alignment. Copies of an item barely change those
shares, so an item copied into many documents keeps its seeds. An item of
common words alone has its rarest run for a seed. Where a document holds a seed, the item is aligned with the words
around it by Smith-Waterman, which tolerates replaced, added and lost words.

Words are counted once for all items. Items are then taken in blocks of a
bounded size, each met by all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_steps

WORD = re.compile(r"\w+")
# Expected chance occurrences of a seed per word of text; words a seed may have.
RATE, SEED_WORDS = 1e-7, range(2, 9)
MATCH, MISMATCH, GAP = 2, -1, -1
# Share of an item's best possible score that tells a copy. By default items count as no longer than this many
# words, so that a passage of half as many is a copy of an item of any length.
LEAST, COUNTED_WORDS = 0.5, 50
# Bytes of item texts in one block.
BLOCK_BYTES = 8 << 20
FACTOR = 0x9E3779B97F4A7C15
HITS = "item_id long, score double, full_share double, first_word long, last_word long, matches long"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass(frozen=True)
class Items:
    """A block of test items: ids, words as numbers (from 1), and seeds by their length."""

    ids: list[int]
    words: list[np.ndarray]
    vocabulary: dict[str, int]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def run_keys(words: np.ndarray, n: int) -> np.ndarray:
    """A key for the ``n`` words from each place on."""
    key = np.zeros(max(0, len(words) - n + 1), "u8")
    with np.errstate(over="ignore"):
        for i in range(n):
            key = (key + words[i : i + len(key)].astype("u8")) * np.uint64(FACTOR)
            key ^= key >> np.uint64(31)
    return key


def seeds_of(words: list[np.ndarray], shares: np.ndarray, total: int) -> dict[int, tuple]:
    """By length: keys in order, and for each the item and the place it stands for."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    logs = np.log(np.maximum(shares, 1.0 / max(total, 1)))
    limit = np.log(RATE)
    for item, row in enumerate(words):
        sums = np.concatenate([[0.0], np.cumsum(logs[row])])
        taken = np.zeros(len(row), bool)
        for n in SEED_WORDS:
            if len(row) < n:
                break
            rare = (sums[n:] - sums[:-n] <= limit) & ~taken[: len(row) - n + 1]
            places = np.flatnonzero(rare)
            taken[places] = True
            keys = run_keys(row, n)
            found.setdefault(n, []).extend((int(keys[p]), item, int(p)) for p in places)
        n = min(len(row), SEED_WORDS[-1])
        if n >= SEED_WORDS[0] and not taken.any():
            p = int(np.argmin(sums[n:] - sums[:-n]))
            found.setdefault(n, []).append((int(run_keys(row, n)[p]), item, p))
    out = {}
    for n, rows in found.items():
        if rows:
            rows.sort()
            out[n] = tuple(np.array(c, k) for c, k in zip(zip(*rows, strict=True), ("u8", "i8", "i8"), strict=True))
    return out


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment: score, first and last word of the text (from 0), equal words.

    Of equally good ends the first in the item, then the first in the text.
    """
    n = len(text)
    gaps = -GAP * np.arange(1, n + 1)
    table = np.zeros((len(item) + 1, n + 1), "i4")
    for i, word in enumerate(item.tolist(), 1):
        above = table[i - 1]
        best = np.maximum(above[:-1] + np.where(text == word, MATCH, MISMATCH), above[1:] + GAP)
        best = np.maximum(best, 0)
        table[i, 1:] = np.maximum.accumulate(best + gaps) - gaps
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    score, last, matches = int(table[i, j]), int(j) - 1, 0
    while i and j and table[i, j]:
        here = table[i, j]
        equal = item[i - 1] == text[j - 1]
        if here == table[i - 1, j - 1] + (MATCH if equal else MISMATCH):
            matches += bool(equal)
            i, j = i - 1, j - 1
        elif here == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, int(j), last, matches


def copies_in(text: str, items: Items, least: float, counted_words: int = COUNTED_WORDS) -> list[tuple]:
    """Per item found: id, share of its best possible score (as counted, and in full), first and last word, equal words."""
    if not items.seeds:
        return []
    look = items.vocabulary.get
    row = np.array([look(w, 0) for w in words_of(text)], "u4")
    if np.count_nonzero(row) < SEED_WORDS[0]:
        return []
    known = row != 0
    hits: dict[int, list[int]] = {}
    for n, (keys, item, place) in items.seeds.items():
        runs = _runs(known, n)
        at = np.flatnonzero(runs)
        if not len(at):
            continue
        wanted = run_keys(row, n)[at]
        low = np.searchsorted(keys, wanted, "left")
        many = np.searchsorted(keys, wanted, "right") - low
        for p, a, m in zip(at[many > 0].tolist(), low[many > 0].tolist(), many[many > 0].tolist(), strict=True):
            for k in range(a, a + m):
                hits.setdefault(int(item[k]), []).append(p - int(place[k]))
    out = []
    for i, starts in hits.items():
        words = items.words[i]
        slack = 8 + len(words) // 4
        need = MATCH * min(len(words), counted_words)
        best: tuple | None = None
        # Neighbouring seeds share a window, cut where the next would begin a copy of its own.
        windows: list[list[int]] = []
        for s in sorted(set(starts)):
            if windows and s - windows[-1][0] <= slack:
                windows[-1][1] = s
            else:
                windows.append([s, s])
        for first, last in windows:
            begin = max(0, first - slack)
            score, a, b, matches = align(words, row[begin : last + len(words) + slack])
            if score >= least * need and (best is None or score > best[0]):
                best = (score, begin + a, begin + b, matches)
        if best:
            out.append((items.ids[i], min(1.0, best[0] / need), best[0] / (MATCH * len(words)), *best[1:]))
    return sorted(out)


def _runs(known: np.ndarray, n: int) -> np.ndarray:
    out = np.ones(max(0, len(known) - n + 1), bool)
    for i in range(n):
        out &= known[i : i + len(out)]
    return out


def item_blocks(benchmark: DataFrame) -> Iterator[tuple[list[int], list[list[str]]]]:
    """Blocks of items with a text and an id; equal rows are one item."""
    ids, words, size = [], [], 0
    usable = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna().distinct()
    for row in usable.orderBy("item_id", "text").toLocalIterator():
        ids.append(row["item_id"])
        words.append(words_of(row["text"]))
        size += len(row["text"])
        if size >= BLOCK_BYTES:
            yield ids, words
            ids, words, size = [], [], 0
    if ids:
        yield ids, words


def word_shares(docs: DataFrame, vocabulary: dict[str, int]) -> tuple[np.ndarray, int]:
    """Per word of the vocabulary its share in the words of all documents, and their number."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, total = shared.value.get, np.zeros(len(shared.value) + 1, "i8")
        for _, texts in text_steps(batches):
            for raw in texts:
                row = np.array([look(w, 0) for w in words_of(raw.decode())], "i8")
                total += np.bincount(row, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["word", "n"])

    found = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(vocabulary) + 1, "i8")
    for r in found.collect():
        counts[r["word"]] = r["n"]
    total = int(counts.sum())
    return counts / max(total, 1), total


def known_items(docs: DataFrame, benchmark: DataFrame) -> Iterator[Items]:
    """Blocks of items with their seeds; the documents' words are counted once for all of them."""
    every: set[str] = set()
    for _, words in item_blocks(benchmark):
        every.update(*words)
    if not every:
        return
    numbers = {w: i for i, w in enumerate(sorted(every), 1)}
    del every
    shares, total = word_shares(docs, numbers)
    for ids, words in item_blocks(benchmark):
        vocabulary = {w: numbers[w] for w in set().union(*words)}
        rows = [np.array([vocabulary[w] for w in row], "u4") for row in words]
        yield Items(ids, rows, vocabulary, seeds_of(rows, shares, total))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: float = LEAST, counted_words: int = COUNTED_WORDS
) -> DataFrame:
    """``doc_id, item_id, score, full_share, first_word, last_word, matches`` for each copy found.

    One row per document row and item, for the best alignment; ``full_share``
    is its share of the item's best possible score, ``score`` the same for an
    item that counts as no longer than ``counted_words``. Null texts and items, items
    without an id and items of a single word match nothing.
    Null and repeated document ids keep their rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for items in known_items(rows, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch, texts in text_steps(batches):
                found = [
                    (doc_id, *hit)
                    for doc_id, raw in zip(batch.column("doc_id").to_pylist(), texts, strict=True)
                    for hit in copies_in(raw.decode(), shared.value, least, counted_words)
                ]
                columns = zip(*found, strict=True) if found else ((),) * 7
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["doc_id", "item_id", "score", "full_share", "first_word", "last_word", "matches"],
                )

        hits = rows.mapInArrow(find, f"doc_id long, {HITS}")
        out = hits if out is None else out.unionByName(hits)
    return docs.sparkSession.createDataFrame([], f"doc_id long, {HITS}") if out is None else out


def without_copies(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` without the documents that hold a copy of a test item; no shuffle."""
    columns = docs.columns
    # The row travels as one value, whatever its columns are called.
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text")
    kind = out.schema
    for items in known_items(docs.select("text"), benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch, texts in text_steps(batches):
                clean = [not copies_in(raw.decode(), shared.value, least) for raw in texts]
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(keep, kind)
    return out.select(*[F.col("row")[c].alias(c) for c in columns])

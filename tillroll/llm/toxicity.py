"""Toxicity by multiple-instance learning: sentences are judged, only documents are labelled.

A sentence gets the probability ``p = sigmoid(bias + sum of feature weights)``;
a document is toxic unless all its sentences are harmless, so its score is the
noisy-or ``1 - product(1 - p)``. Weights are fitted to document labels by the
likelihood of the noisy-or: in a toxic document the gradient goes to the
sentences that already look worst, in a clean one every sentence is pushed
down. Afterwards each sentence's own ``p`` tells where the offence is.

Features of a word are the word and its beginnings, hashed; a word is a run of
letters, lower-cased. A sentence ends at ``.``, ``!``, ``?`` or a line break,
and after ``SENTENCE_WORDS`` words where there is no such mark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import id_remainder, stored, text_steps
from tillroll.llm.language_id import code_points, letter_map

# The bound of the fitted sample: distinct texts a class, and words of one class's texts.
SAMPLE_TEXTS, SAMPLE_WORDS = 6000, 1_500_000
BEGINNINGS = (3, 4, 5, 6, 7)
FEATURES = len(BEGINNINGS) + 1
BITS = 18
SENTENCE_WORDS = 32
ENDS = tuple(map(ord, ".!?\n\r"))
# Fitting: passes over the sample, texts a step, step width, weight of the absolute values.
PASSES, STEP_TEXTS, RATE, SPARSE = 20, 128, 0.2, 0.05
# A text longer than this is judged in parts that end with a sentence.
LONG = 1 << 20
SENTENCE_END = re.compile(rb"[.!?\n\r]")
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX, KIND = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA24BAED4963EE407)


@dataclass(frozen=True)
class Sentences:
    """Sentences of some texts in a row: features by word, first word of each, owner, and where it lies."""

    features: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray


def sentences_of(texts: list[bytes]) -> Sentences:
    """All sentences with a word; places are code points of their own text, ends exclusive."""
    letters, lower = letter_map()
    rows = [code_points(t) for t in texts]
    # One line break behind each text keeps sentences and words of different texts apart.
    points = np.concatenate([np.append(r, np.uint32(10)) for r in rows]) if rows else np.zeros(0, "<u4")
    base = np.cumsum([0, *(len(r) + 1 for r in rows)])
    word = letters[points]
    edge = np.diff(np.concatenate([[0], word.view("i1"), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        none = np.zeros(0, "i8")
        return Sentences(np.zeros((0, FEATURES), "u4"), none, none, none, none)
    marks = np.cumsum(np.isin(points, ENDS))
    opens = np.append(True, np.diff(marks[begin]) > 0)
    head = np.flatnonzero(opens)
    inside = np.arange(len(begin)) - np.repeat(head, np.diff(np.append(head, len(begin))))
    first = np.flatnonzero(inside % SENTENCE_WORDS == 0)
    last = np.append(first[1:], len(begin)) - 1
    owner = np.searchsorted(base, begin[first], "right") - 1
    return Sentences(
        word_features(lower[points], begin, end), first, owner, begin[first] - base[owner], end[last] - base[owner]
    )


def word_features(points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One row of hashed features per word: the word, then its beginnings (of a short word, the word again)."""
    out = np.empty((len(begin), FEATURES), "u4")
    length = end - begin
    hashed, at = np.zeros(len(begin), "u8"), 0
    for k in range(int(length.max())):
        # Beginnings grow letter by letter; only words that are long enough go on.
        live = np.flatnonzero(length > k) if k else np.arange(len(begin))
        hashed[live] = hashed[live] * BASE + points[begin[live] + k] + np.uint64(1)
        if k + 1 in BEGINNINGS:
            at += 1
            out[:, at] = folded(hashed, 0)
        if len(live) < len(begin) // 64 and k + 1 >= BEGINNINGS[-1]:
            finish(points, begin[live], end[live], k + 1, hashed, live)
            break
    for rest in range(at + 1, FEATURES):
        out[:, rest] = folded(hashed, 0)
    out[:, 0] = folded(hashed, 1)
    return out


def finish(points: np.ndarray, begin: np.ndarray, end: np.ndarray, done: int, hashed: np.ndarray, live: np.ndarray) -> None:
    """Hashes the rest of the few longest words from one sum over their letters, to the same values."""
    for i, a, b in zip(live.tolist(), begin.tolist(), end.tolist(), strict=True):
        rest = points[a + done : b].astype("u8") + np.uint64(1)
        if len(rest):
            powers = np.cumprod(np.append(np.uint64(1), np.full(len(rest), BASE)))
            hashed[i : i + 1] = hashed[i : i + 1] * powers[-1] + (rest * powers[-2::-1]).sum(dtype="u8")


def folded(hashed: np.ndarray, kind: int) -> np.ndarray:
    mixed = (hashed + KIND * np.uint64(kind)) * MIX
    mixed ^= mixed >> np.uint64(32)
    mixed *= MIX
    return ((mixed ^ (mixed >> np.uint64(29))) * BASE >> np.uint64(64 - BITS)).astype("u4")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def sentence_logits(self, found: Sentences) -> np.ndarray:
        if not len(found.first):
            return np.zeros(0)
        words = self.weights[found.features].sum(axis=1, dtype="f8")
        return np.add.reduceat(words, found.first) + self.bias


def harm(logits: np.ndarray) -> np.ndarray:
    """``-log(1 - p)`` of each sentence."""
    return np.logaddexp(0.0, logits)


def fit(samples: list[tuple[int, float, Sentences]]) -> Model:
    """Weights for ``(label, weight, sentences)`` of sampled texts, each with at least one sentence.

    Steps of adaptive width along the gradient of the noisy-or likelihood; the
    weights' absolute values are charged, so that few differ from 0.
    """
    width = 1 << BITS
    weights, squares = np.zeros(width), np.full(width, 1e-6)
    toxic = sum(w for y, w, _ in samples if y)
    total = sum(w for _, w, _ in samples)
    sizes = sum(w * len(s.first) for _, w, s in samples) / max(total, 1e-9)
    # Unfitted, the typical text has the share of toxic ones as its score.
    share = min(max(toxic / max(total, 1e-9), 1e-3), 1 - 1e-3)
    bias = float(np.log(np.expm1(-np.log1p(-share) / max(sizes, 1.0))))
    bias_squares = 1e-6
    order = np.random.default_rng(12)
    for _ in range(PASSES):
        dealt = order.permutation(len(samples))
        for at in range(0, len(dealt), STEP_TEXTS):
            part = [samples[i] for i in dealt[at : at + STEP_TEXTS]]
            features = np.concatenate([s.features for _, _, s in part])
            words = np.array([len(s.features) for _, _, s in part])
            counts = np.array([len(s.first) for _, _, s in part])
            first = np.concatenate([s.first for _, _, s in part]) + np.repeat(np.cumsum(words) - words, counts)
            logits = np.add.reduceat(weights[features].sum(axis=1), first) + bias
            heads = np.cumsum(counts) - counts
            total_harm = np.add.reduceat(harm(logits), heads)
            label = np.array([y for y, _, _ in part])
            weight = np.array([w for _, w, _ in part])
            pull = weight * np.where(label == 1, -1 / np.expm1(np.clip(total_harm, 1e-9, 500)), 1.0)
            slope = np.repeat(pull, counts) / (1 + np.exp(-logits))
            each = np.repeat(slope, np.diff(np.append(first, len(features))))
            gradient = np.bincount(features.ravel(), np.repeat(each, FEATURES), width) / len(part)
            squares += gradient**2
            step = RATE / np.sqrt(squares)
            moved = weights - step * gradient
            # Only what was seen shrinks, at the rate at which it is seen.
            weights = np.where(gradient == 0, weights, np.sign(moved) * np.maximum(np.abs(moved) - step * SPARSE / len(part), 0))
            slope_sum = slope.sum() / len(part)
            bias_squares += slope_sum**2
            bias -= RATE / np.sqrt(bias_squares) * slope_sum
    return Model(weights.astype("f4"), bias)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from learning: crc32 of its id leaves 0 modulo 5."""
    return id_remainder(doc_id, 5) == 0


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model | None:
    """A model from the labels of the documents that are not held out; None without any.

    Per class the sample is made of at most ``SAMPLE_TEXTS`` distinct texts
    with the smallest hashes, each whole, until they have ``SAMPLE_WORDS``
    words (at one per six characters); longer ones are left out. Each class weighs what it weighs among
    all labelled documents. A document labelled more than once is toxic if
    one label says so; null labels count as none.
    """
    spark = docs.sparkSession
    own = docs.filter(~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    hashed = own.select("doc_id", F.xxhash64("text").alias("h"), F.length("text").alias("chars"))
    told = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    told = told.groupBy("doc_id").agg(F.max((F.col(label) == 1).cast("int")).alias("y"))
    texts = stored(
        hashed.join(told, "doc_id").groupBy("y", "h").agg(
            F.min("doc_id").alias("doc_id"), F.max("chars").alias("chars"), F.count(F.lit(1)).alias("n")
        ),
        "toxicity-texts",
    )
    share = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    if not share:
        return None
    picked = []
    for y in sorted(share):
        words = 0
        fitting = texts.filter((F.col("y") == y) & (F.col("chars") < 6 * SAMPLE_WORDS))
        for r in fitting.orderBy("h").limit(SAMPLE_TEXTS).collect():
            words += r["chars"] // 6 + 1
            if words > SAMPLE_WORDS:
                break
            picked.append((r["doc_id"], r["h"], y))
    chosen = spark.createDataFrame(picked, "doc_id long, h long, y int")
    found = own.withColumn("h", F.xxhash64("text")).select(F.col("doc_id").cast("long").alias("doc_id"), "h", "text")
    # At most 2 * SAMPLE_TEXTS rows of numbers are broadcast.
    sample = found.join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"])
    rows = []
    for r in sorted(sample.collect(), key=lambda r: (r["h"], r["doc_id"])):
        own_sentences = sentences_of([r["text"].encode()])
        if len(own_sentences.first):
            rows.append((r["y"], own_sentences))
    of_class = {y: sum(1 for other, _ in rows if other == y) for y in share}
    total = sum(share.values())
    return fit([(y, share[y] / total / of_class[y] * len(rows), s) for y, s in rows])


def pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts, long ones in parts that end with a sentence: owner, code points before, bytes; about ``LONG`` together."""
    owners: list[int] = []
    before: list[int] = []
    parts: list[bytes] = []
    size = 0
    for i, raw in enumerate(texts):
        at = points = 0
        while at < len(raw):
            mark = SENTENCE_END.search(raw, at + LONG)
            stop = mark.end() if mark else len(raw)
            part = raw[at:stop]
            owners.append(i)
            before.append(points)
            parts.append(part)
            size += len(part)
            if stop < len(raw):
                points += len(part.decode("utf-8", "replace"))
            at = stop
            if size >= LONG:
                yield owners, before, parts
                owners, before, parts, size = [], [], [], 0
    if parts:
        yield owners, before, parts


def judge_texts(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray, list[list[dict]]]:
    """Score and number of sentences per text, and its offending sentences.

    Offending are sentences of probability 0.5 or more; a text with a score of
    0.5 or more that has none names its worst one, the first of equals.
    """
    total, count = np.zeros(len(texts)), np.zeros(len(texts), "i8")
    offending: list[list[dict]] = [[] for _ in texts]
    worst: list[dict | None] = [None] * len(texts)
    for owners, before, parts in pieces(texts):
        found = sentences_of(parts)
        logits = model.sentence_logits(found)
        owner, ahead = np.array(owners), np.array(before)
        np.add.at(total, owner[found.owner], harm(logits))
        np.add.at(count, owner[found.owner], 1)
        chance = 1 / (1 + np.exp(-logits))
        head = np.flatnonzero(np.append(True, np.diff(found.owner) > 0)) if len(chance) else np.zeros(0, "i8")
        top = np.maximum.reduceat(chance, head) if len(head) else chance
        best = np.flatnonzero(chance == np.repeat(top, np.diff(np.append(head, len(chance)))))
        for k in np.union1d(best[np.append(True, np.diff(found.owner[best]) > 0)] if len(best) else best, np.flatnonzero(chance >= 0.5)):
            i, add = int(owner[found.owner[k]]), int(ahead[found.owner[k]])
            place = {"start": int(found.start[k]) + add, "end": int(found.end[k]) + add, "score": float(chance[k])}
            if place["score"] >= 0.5:
                offending[i].append(place)
            if worst[i] is None or place["score"] > worst[i]["score"]:
                worst[i] = place
    score = -np.expm1(-total)
    for i in np.flatnonzero(score >= 0.5):
        offending[i] = offending[i] or [worst[i]]
    return score, count, offending


def judge(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``score, n_sentences, offending`` (code points, ends exclusive); only ``text`` is looked at.

    Null and empty texts and texts without a letter have score 0 and no
    sentence; so has every text where no model could be learned.
    """
    rows = docs.select(*keep, F.col("text").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model or Model(np.zeros(1 << BITS, "f4"), -100.0))
    place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_steps(batches, len(keep)):
            score, count, offending = judge_texts(texts, shared.value)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(score), pa.array(count), pa.array(offending, place)],
                names=[*keep, "score", "n_sentences", "offending"],
            )

    out = "score double, n_sentences long, offending array<struct<start: long, end: long, score: double>>"
    return rows.mapInArrow(step, f"{kinds}, {out}")


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, with its sentences counted and the worst one's place.

    Null and repeated ids keep their rows; null ids are held out. Other columns
    are ignored, empty tables give an empty result or, without labels, score 0.
    """
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    model = learn(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    found = judge(rows, model, ["doc_id", "held_out"])
    worst = F.array_max(F.transform("offending", lambda x: F.struct(x["score"], (-x["start"]).alias("back"), x["end"])))
    return found.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences",
        F.size("offending").cast("long").alias("n_offending"), (-worst["back"]).alias("worst_start"),
        worst["end"].alias("worst_end"), worst["score"].alias("worst_score"),
    )

"""Language identification by cross-parsing entropy.

A language is known by the suffix automaton of a sample of its texts, which
accepts exactly the strings that occur in the sample. A text is parsed from
left to right into phrases, each the longest match in the sample; the fewer
phrases a text needs, the closer it is to the language. A phrase costs the
logarithm of the sample's length, so that samples of different lengths
compare. The language with the least cost per letter wins.

Before, a text becomes a row of symbols: letters in lower case, each run of
other characters one blank, letters of no sample a symbol that never matches.
It is parsed in segments of ``SEGMENT`` symbols, so that many of them advance
together; a phrase ends with its segment, in every language alike.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import id_remainder, shuffle_partitions, text_steps

# Sampled letters per language and texts looked at for them: the bound of the fitted sample.
SAMPLE_CHARS, SAMPLE_TEXTS = 24_000, 64
SEGMENT, TOGETHER = 512, 4096
UNDETERMINED = "und"
BLANK = 0
RESTART = np.int32(-(1 << 31))


@cache
def letter_map() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter, and its lower case where that is one code point."""
    n = sys.maxunicode + 1
    letters, lower = np.zeros(n, bool), np.arange(n, dtype="u4")
    for i in range(n):
        c = chr(i)
        if c.isalpha():
            letters[i] = True
            low = c.lower()
            if len(low) == 1:
                lower[i] = ord(low)
    return letters, lower


def code_points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), "<u4")


def automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


@dataclass(frozen=True)
class Languages:
    """Samples ready for parsing.

    ``table`` holds, for each state and symbol, where the next state's row
    begins; the top bit says that a new phrase starts with this symbol.
    """

    names: list[str]
    symbols: list[int]
    table: np.ndarray
    starts: np.ndarray
    phrase_bits: np.ndarray

    @property
    def width(self) -> int:
        return len(self.symbols) + 2

    def symbol_map(self) -> np.ndarray:
        """Per code point its symbol: 0 blank, the last one for letters of no sample."""
        letters, lower = letter_map()
        of = np.full(len(letters), self.width - 1, "u2")
        of[self.symbols] = np.arange(1, self.width - 1)
        return np.where(letters, of[lower], BLANK).astype("u2")


def learn(samples: dict[str, np.ndarray]) -> Languages:
    """Languages from rows of lower-case letters (as code points) and blanks (0)."""
    names = sorted(samples)
    symbols = sorted(set().union(*(set(np.unique(s).tolist()) for s in samples.values())) - {0})
    at = {0: BLANK} | {c: i for i, c in enumerate(symbols, 1)}
    width = len(symbols) + 2
    rows, starts, base = [], [], 0
    for name in names:
        step = automaton([at[c] for c in samples[name].tolist()])
        goes = np.full((len(step), width), -1, "i8")
        for state, moves in enumerate(step):
            goes[state, list(moves)] = list(moves.values())
        # One more state stands before any phrase, where the next symbol always opens one.
        goes = np.vstack([goes, np.full(width, -1)])
        fresh = len(step)
        opened = np.where(goes[0] >= 0, goes[0], fresh)
        restart = goes < 0
        target = ((np.where(restart, opened[None], goes) + base) * width).astype("i4")
        rows.append(np.where(restart, target | RESTART, target))
        starts.append((base + fresh) * width)
        base += fresh + 1
    bits = np.log2([max(2, len(samples[n])) for n in names])
    return Languages(names, symbols, np.concatenate(rows).ravel().astype("i4"), np.array(starts), bits)


def normal_symbols(text: bytes, mapping: np.ndarray) -> np.ndarray:
    """The symbols of a text, runs of blanks joined and outer ones dropped."""
    row = mapping[code_points(text)]
    keep = row != BLANK
    keep[1:] |= row[:-1] != BLANK
    row = row[keep] if len(row) else row
    if len(row) and row[0] == BLANK:
        row = row[1:]
    return row[:-1] if len(row) and row[-1] == BLANK else row


def count_phrases(rows: list[np.ndarray], languages: Languages) -> np.ndarray:
    """Phrases per text and language."""
    out = np.zeros((len(rows), len(languages.names)), "i8")
    segments = [(i, r[at : at + SEGMENT]) for i, r in enumerate(rows) for at in range(0, len(r), SEGMENT)]
    segments.sort(key=lambda s: -len(s[1]))
    mask = np.int32(~RESTART)
    for begin in range(0, len(segments), TOGETHER):
        part = segments[begin : begin + TOGETHER]
        sizes = np.array([len(s) for _, s in part])
        grid = np.zeros((sizes[0], len(part)), "i4")
        for j, (_, s) in enumerate(part):
            grid[: len(s), j] = s
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
        state = np.repeat(languages.starts.astype("i4")[:, None], len(part), axis=1)
        count = np.zeros(state.shape, "i4")
        for k in range(sizes[0]):
            n = active[k]
            moved = languages.table[state[:, :n] + grid[k, :n]]
            count[:, :n] -= moved >> 31
            state[:, :n] = moved & mask
        np.add.at(out, np.array([i for i, _ in part]), count.T)
    return out


def sample_languages(labelled: DataFrame) -> Languages:
    """Learns from rows ``text, lang``, both non-null.

    Per language the sample is made of at most ``SAMPLE_TEXTS`` distinct texts
    with the smallest hashes, each whole, until they have ``SAMPLE_CHARS``
    letters and blanks; the last one is cut there. Nothing else about the rows
    counts.
    """
    spark = labelled.sparkSession
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = usable.select("lang", F.xxhash64("text").alias("_h"))
    # The smallest of each share of the hashes first, so that no task sees all of a language.
    own = F.pmod(F.col("_h"), F.lit(max(16, shuffle_partitions(spark))))
    listed = hashed.distinct().withColumn("_share", own)
    for keys in (["lang", "_share"], ["lang"]):
        smallest = Window.partitionBy(*keys).orderBy("_h")
        listed = listed.withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= SAMPLE_TEXTS)
    chosen = [(r["lang"], r["_h"], r["_n"]) for r in listed.collect()]
    if not chosen:
        return Languages([], [], np.zeros(0, "i4"), np.zeros(0, "i8"), np.zeros(0))
    # At most SAMPLE_TEXTS rows a language are broadcast, so only texts of the sample are shuffled.
    wanted = F.broadcast(spark.createDataFrame(chosen, "lang string, _h long, _n int"))
    picked = usable.withColumn("_h", F.xxhash64("text")).join(wanted, ["lang", "_h"])
    picked = picked.groupBy("lang", "_n").agg(F.min("text").alias("text"))
    texts: dict[str, list[np.ndarray]] = {}
    letters, lower = letter_map()
    # One task hands over the few texts, one after the other.
    for row in picked.coalesce(1).sortWithinPartitions("lang", "_n").toLocalIterator():
        own = texts.setdefault(row["lang"], [])
        if sum(map(len, own)) < SAMPLE_CHARS:
            points = code_points(row["text"].encode())
            mapping = np.where(letters[points], lower[points], 0).astype("u4")
            keep = mapping != 0
            keep[1:] |= mapping[:-1] != 0
            own.append(np.append(mapping[keep], np.uint32(0))[:SAMPLE_CHARS])
    samples = {k: np.concatenate(v)[:SAMPLE_CHARS] for k, v in texts.items()}
    return learn(samples) if samples else Languages([], [], np.zeros(0, "i4"), np.zeros(0, "i8"), np.zeros(0))


def predict(
    docs: DataFrame, languages: Languages, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """Adds the language and the score to the columns ``keep``; only ``text`` is looked at.

    The score is the share of the second-best language's cost in the sum of
    both, 1 when only one language is known. Null texts, texts without a
    letter and all texts when nothing was learned are ``und`` with score 0.
    Ties go to the name that sorts first.
    """
    rows = docs.select(*keep, F.col("text").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(languages)
    schema = rows.select(*keep).schema.add(names[0], "string").add(names[1], "double")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        mapping = known.symbol_map() if known.names else None
        for batch, texts in text_steps(batches, len(keep)):
            told: list[str] = [UNDETERMINED] * len(texts)
            scores = np.zeros(len(texts))
            if mapping is not None:
                symbols = [normal_symbols(t, mapping) for t in texts]
                cost = count_phrases(symbols, known) * known.phrase_bits
                best = cost.argmin(1)
                ordered = np.sort(cost, axis=1)
                for i in range(len(texts)):
                    if len(symbols[i]):
                        told[i] = known.names[best[i]]
                        two = ordered[i, :2]
                        scores[i] = two[1] / two.sum() if len(two) == 2 else 1.0
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(told, pa.string()), pa.array(scores)], names=[*keep, *names]
            )

    return rows.mapInArrow(step, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id leaves 2 modulo 4."""
    return id_remainder(doc_id, 4) == 2


def language_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document.

    Learned from the documents that are not held out. Null and repeated ids
    keep their rows; other columns are ignored.
    """
    rows = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    languages = sample_languages(rows.filter(~F.col("held_out")).select("text", "lang"))
    return predict(rows, languages, ["doc_id", "held_out"])


def reject_undetermined(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose language can't be determined; a null ``lang`` becomes the one predicted."""
    languages = sample_languages(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))
    # The row travels as one value, so that no column of it can clash with the ones added.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = predict(docs.select(row, "text"), languages, ["row"]).filter(F.col("lang_pred") != UNDETERMINED)
    filled = {"lang": F.coalesce(F.col("row")["lang"], F.col("lang_pred"))}
    return found.select(*[filled.get(c, F.col("row")[c]).alias(c) for c in docs.columns])

"""SimHash near-duplicates by the generalised pigeonhole principle.

If two fingerprints differ in at most ``distance`` bits and the bits are dealt
into m parts, then for any thresholds t_i >= -1 with a sum of
``distance - m + 1`` some part differs in at most t_i bits. Correlated bits
share a part, and every fingerprint gets thresholds of its own: a dynamic
programme picks the split with the least work, from counts of the values that
each part takes. A fingerprint probes all values within t_i of its part i
(none for -1) and meets those that hold the value; every meeting is verified
on all 64 bits, so the links are exact whatever the estimates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property
from itertools import combinations, repeat
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import shuffle_partitions, stored, text_steps
from tillroll.llm.components import connected_components, merge_labels

BITS, SEED = 64, 42
# Shingles whose bits are counted together; meetings verified together.
COUNTED, VERIFIED = 1 << 16, 1 << 20
# Work of a row that is shuffled and of a meeting that is verified.
ROW_COST, MEETING_COST = 1.0, 0.02
# Bits of a part for which values are counted; holders of a value met by one block.
COUNTED_BITS, BLOCK = 16, 50_000
# Rows per group handed to one call.
GROUP_ROWS = 200_000


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of the word shingles of a UTF-8 text, A-Z in lower case, repeats kept."""
    found = text.lower().split()
    if not found:
        return []
    if len(found) < words:
        return [xxhash.xxh64_intdigest(b" ".join(found), SEED)]
    shingles = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False))
    return list(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)))


def fingerprints_of(texts: list[bytes], words: int) -> np.ndarray:
    """Per text the bits that are set in over half of its shingle hashes; 0 without words."""
    sums, sizes = np.zeros((len(texts), BITS), "i8"), np.zeros(len(texts), "i8")
    held: list[int] = []
    owners: list[int] = []

    def count() -> None:
        if not held:
            return
        bits = np.unpackbits(np.array(held, "<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
        owner = np.array(owners)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        np.add.at(sums, owner[first], np.add.reduceat(bits, first, axis=0, dtype="i8"))
        held.clear()
        owners.clear()

    for i, text in enumerate(texts):
        hashes = shingle_hashes(text, words)
        sizes[i] = len(hashes)
        for at in range(0, len(hashes), COUNTED):
            part = hashes[at : at + COUNTED]
            held.extend(part)
            owners.extend(repeat(i, len(part)))
            if len(held) >= COUNTED:
                count()
    count()
    over = 2 * sums > sizes[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id, fp, h``: the 64 bits as they are (long), and a hash of the text, of every whole text.

    Null texts are empty; a text without words has fingerprint zero; one with
    fewer words than a shingle is one shingle. Null and repeated ids keep
    their rows. Other columns are ignored.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_steps(batches):
            fp = fingerprints_of(texts, words).view("<i8")
            told = [batch.column("doc_id"), pa.array(fp), batch.column("h")]
            yield pa.RecordBatch.from_arrays(told, names=["doc_id", "fp", "h"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    return rows.mapInArrow(step, "doc_id long, fp long, h long")


def bit_parts(correlation: np.ndarray, m: int) -> list[list[int]]:
    """``m`` parts of nearly equal size; each grows by the bit most correlated with it."""
    rest, parts = set(range(BITS)), []
    strength = np.abs(np.nan_to_num(correlation))
    for i in range(m):
        size = BITS // m + (i < BITS % m)
        part = [min(rest)]
        rest.discard(part[0])
        while len(part) < size:
            best = max(sorted(rest), key=lambda j: strength[j, part].sum())
            part.append(best)
            rest.discard(best)
        parts.append(sorted(part))
    return parts


def part_values(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, packed from the lowest on."""
    out = np.zeros(len(fp), "u8")
    for i, bit in enumerate(bits):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)) << np.uint64(i)
    return out


def ball_counts(counts: np.ndarray, width: int, distance: int) -> np.ndarray:
    """Rows 0..distance: estimated holders within that many bits of each counted value.

    Bits beyond those counted are taken as even.
    """
    bits = len(counts).bit_length() - 1
    shells = np.zeros((distance + 1, len(counts)))
    shells[0] = counts
    values = np.arange(len(counts))
    for b in range(bits):
        shells[1:] += shells[:-1][:, values ^ (1 << b)]
    rest = width - bits
    if rest:
        ways = [comb(rest, j) / 2**rest for j in range(distance + 1)]
        shells = np.array([sum(ways[j] * shells[d - j] for j in range(d + 1)) for d in range(distance + 1)])
    return np.cumsum(shells, axis=0)


def probe_costs(balls: np.ndarray, width: int) -> np.ndarray:
    """Work of thresholds -1, 0, 1, ... for each counted value."""
    probes = np.cumsum([comb(width, j) for j in range(len(balls))])
    return np.vstack([np.zeros(balls.shape[1]), probes[:, None] * ROW_COST + balls * MEETING_COST])


def allocate(costs: list[np.ndarray], total: int) -> np.ndarray:
    """Thresholds + 1 per part and fingerprint, with the given sum and the least work.

    ``costs[i][t]`` holds the work of part i at threshold t - 1 for each fingerprint.
    """
    n = costs[0].shape[1]
    best = np.full((total + 1, n), np.inf)
    best[0] = 0
    choices = []
    for cost in costs:
        options = np.full((total + 1, total + 1, n), np.inf)
        for s in range(total + 1):
            for t in range(min(s, len(cost) - 1) + 1):
                options[s, t] = best[s - t] + cost[t]
        choices.append(options.argmin(axis=1))
        best = options.min(axis=1)
    left, picked = np.full(n, total), []
    for choice in reversed(choices):
        t = choice[left, np.arange(n)]
        picked.append(t)
        left = left - t
    return np.array(picked[::-1])


@dataclass(frozen=True)
class Probing:
    """Parts, counts of their values and the work they imply."""

    parts: list[list[int]]
    counts: list[np.ndarray]
    distance: int
    # Probes that each counted value gets, by part; None before they are counted.
    probes: list[np.ndarray] | None = None

    @cached_property
    def work(self) -> list[np.ndarray]:
        """Per part the work of each threshold for each counted value."""
        return [
            probe_costs(ball_counts(counts, len(bits), self.distance), len(bits))
            for bits, counts in zip(self.parts, self.counts, strict=True)
        ]

    def thresholds(self, fp: np.ndarray) -> np.ndarray:
        costs = []
        for bits, counts, work in zip(self.parts, self.counts, self.work, strict=True):
            low = part_values(fp, bits) & np.uint64(len(counts) - 1)
            costs.append(work[:, low.astype("i8")])
        return allocate(costs, self.distance + 1)

    def blocks(self, part: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks among which the holders and the probers of each value are dealt: 1, unless there are very many."""
        counts = self.counts[part]
        low = (values & np.uint64(len(counts) - 1)).astype("i8")
        held = np.maximum(1, -(-counts[low] // BLOCK)).astype("i8")
        if self.probes is None:
            return held, held
        return held, np.maximum(1, -(-self.probes[part][low] // BLOCK)).astype("i8")

    def targets(self, fp: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Part, fingerprints (by place) and the values they probe, for all flips their thresholds ask for."""
        picked = self.thresholds(fp)
        for i, bits in enumerate(self.parts):
            value = part_values(fp, bits)
            for t in range(int(picked[i].max(initial=0))):
                near = np.flatnonzero(picked[i] > t)
                for flips in combinations(range(len(bits)), t):
                    yield i, near, value[near] ^ np.uint64(sum(1 << f for f in flips))


def even_work(n: int, m: int, distance: int) -> float:
    """Work a fingerprint would cause in ``m`` parts if all values were equally frequent."""
    costs = []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        balls = np.cumsum([n * comb(width, j) / 2.0**width for j in range(distance + 1)])
        costs.append(probe_costs(balls[:, None], width))
    picked = allocate(costs, distance + 1)
    return m * ROW_COST + sum(c[t[0], 0] for c, t in zip(costs, picked, strict=True))


def probing_of(prints: DataFrame, distance: int) -> Probing:
    """Statistics over all distinct fingerprints: bit correlations, then value counts.

    What reaches the driver is 64 x 64 sums and at most 2^16 counts per part.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            fp = np.ascontiguousarray(batch.column(0).to_numpy()).view("u1").reshape(-1, 8)
            for at in range(0, len(fp), COUNTED):
                bits = np.unpackbits(fp[at : at + COUNTED], axis=1, bitorder="little").astype("f4")
                total += bits.T @ bits
        yield pa.RecordBatch.from_pydict({"i": np.arange(BITS * BITS, dtype="i4"), "n": total.ravel()})

    n = prints.count()
    rows = prints.select("fp").mapInArrow(sums, "i int, n double").groupBy("i").agg(F.sum("n").alias("n")).collect()
    both = np.zeros(BITS * BITS)
    for r in rows:
        both[r["i"]] = r["n"]
    both = both.reshape(BITS, BITS) / max(n, 1)
    mean = np.diag(both)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    correlation = (both - np.outer(mean, mean)) / np.outer(spread, spread)
    m = min(range(2, distance + 2), key=lambda m: even_work(n, m, distance)) if distance else 1
    parts = bit_parts(correlation, m)
    counted = [bits[:COUNTED_BITS] for bits in parts]

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.zeros(1 << len(bits), "i8") for bits in counted]
        for batch in batches:
            fp = np.ascontiguousarray(batch.column(0).to_numpy()).view("u8")
            for i, bits in enumerate(counted):
                found[i] += np.bincount(part_values(fp, bits).astype("i8"), minlength=len(found[i]))
        for i, row in enumerate(found):
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, "i4")), pa.array(at), pa.array(row[at])], names=["part", "value", "n"]
            )

    kind = "part int, value long, n long"
    totals = prints.select("fp").mapInArrow(values, kind).groupBy("part", "value").agg(F.sum("n").alias("n"))
    counts = [np.zeros(1 << len(bits), "i8") for bits in counted]
    seen = totals.toPandas()
    for i in range(m):
        own = seen[seen["part"] == i]
        counts[i][own["value"].to_numpy()] = own["n"].to_numpy()
    return Probing(parts, counts, distance)


def with_probes(prints: DataFrame, probing: Probing) -> Probing:
    """Counts all probes by part and value; as many counts as for the holders reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.zeros(len(c), "i8") for c in probing.counts]
        for batch in batches:
            fp = np.ascontiguousarray(batch.column(0).to_numpy()).view("u8")
            for i, _, seen in probing.targets(fp):
                low = (seen & np.uint64(len(found[i]) - 1)).astype("i8")
                np.add.at(found[i], low, 1)
        for i, row in enumerate(found):
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, "i4")), pa.array(at), pa.array(row[at])], names=["part", "value", "n"]
            )

    kind = "part int, value long, n long"
    totals = prints.select("fp").mapInArrow(count, kind).groupBy("part", "value").agg(F.sum("n").alias("n"))
    probes = [np.zeros(len(c), "i8") for c in probing.counts]
    for r in totals.filter(F.col("n") > BLOCK).toLocalIterator():
        probes[r["part"]][r["value"]] = r["n"]
    return replace(probing, probes=probes)


def meeting_rows(fp: np.ndarray, probing: Probing, groups: int) -> Iterator[pa.RecordBatch]:
    """Rows (group, meeting, probes, fp): where fingerprints are held and where they probe.

    A holder is in one block of its value's holders and meets every block of
    its probers, and the other way round, so no meeting grows with either.
    """
    mix = (fp * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype("i8")

    def every(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each place repeated as often as told, and the number of the repetition."""
        who = np.repeat(np.arange(len(n)), n)
        return who, np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)

    for i, bits in enumerate(probing.parts):
        value = part_values(fp, bits)
        holders, probers = probing.blocks(i, value)
        who, prober = every(probers)
        yield _rows(i, value[who], mix[who] % holders[who], prober, fp[who], False, groups)
    for i, near, seen in probing.targets(fp):
        holders, probers = probing.blocks(i, seen)
        who, holder = every(holders)
        yield _rows(i, seen[who], holder, mix[near][who] % probers[who], fp[near][who], True, groups)


def _rows(part, value, holder, prober, fp, probes, groups) -> pa.RecordBatch:
    """``holder`` and ``prober`` are blocks; a hash of all four decides the meeting.

    Two places with the same hash only cause meetings that verification refuses.
    """
    with np.errstate(over="ignore"):
        meeting = value * np.uint64(0x9E3779B97F4A7C15) + np.uint64(part + 1) * np.uint64(0xC2B2AE3D27D4EB4F)
        meeting ^= holder.astype("u8") * np.uint64(0x165667B19E3779F9) + prober.astype("u8") * np.uint64(0x27D4EB2F165667C5)
        meeting ^= meeting >> np.uint64(29)
        meeting *= np.uint64(0xBF58476D1CE4E5B9)
        meeting ^= meeting >> np.uint64(32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array((meeting % np.uint64(groups)).astype("i4")),
            pa.array(meeting.view("i8")),
            pa.array(np.full(len(fp), probes)),
            pa.array(fp.view("i8")),
        ],
        names=["grp", "meeting", "probes", "fp"],
    )


def verified_links(pdf: pd.DataFrame, distance: int) -> pd.DataFrame:
    """A star per group of linked fingerprints: as many rows as fingerprints at most."""
    fp = pdf["fp"].to_numpy().view("u8")
    meeting, probes = pdf["meeting"].to_numpy(), pdf["probes"].to_numpy()
    nodes, node = np.unique(fp, return_inverse=True)
    labels = np.arange(len(nodes))
    held = np.flatnonzero(~probes)
    held = held[np.argsort(meeting[held], kind="stable")]
    asks = np.flatnonzero(probes)
    low = np.searchsorted(meeting[held], meeting[asks], "left")
    many = np.searchsorted(meeting[held], meeting[asks], "right") - low
    asks, low, many = asks[many > 0], low[many > 0], many[many > 0]
    total = int(many.sum())
    ends = np.cumsum(many)
    for begin in range(0, total, VERIFIED):
        k = np.arange(begin, min(begin + VERIFIED, total))
        who = np.searchsorted(ends, k, "right")
        a = node[asks[who]]
        b = node[held[low[who] + k - (ends[who] - many[who])]]
        near = (np.bitwise_count(nodes[a] ^ nodes[b]) <= distance) & (a != b)
        merge_labels(labels, a[near], b[near])
    linked = np.flatnonzero(labels != np.arange(len(nodes)))
    return pd.DataFrame({"a": nodes[linked].view("i8"), "b": nodes[labels[linked]].view("i8")})


def fingerprint_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links ``a, b`` whose components are those of all pairs within ``distance`` bits.

    ``prints`` holds distinct fingerprints as ``fp``. A component is complete,
    but only a spanning set of its pairs is returned.
    """
    if not prints.take(1):
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    probing = with_probes(prints, probing_of(prints, distance))
    n = sum(int(c.sum()) for c in probing.counts[:1])
    per_print = even_work(n, len(probing.parts), distance) / ROW_COST
    groups = max(4 * shuffle_partitions(prints.sparkSession), int(n * per_print / GROUP_ROWS) + 1)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.ascontiguousarray(batch.column(0).to_numpy()).view("u8")
            yield from meeting_rows(fp, probing, groups)

    rows = prints.select("fp").mapInArrow(spread, "grp int, meeting long, probes boolean, fp long")
    return rows.groupBy("grp").applyInPandas(lambda pdf: verified_links(pdf, distance), "a long, b long")


def simhash_groups(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, fp, h, component_fp, component_id`` of every document; ``h`` is a hash of the text.

    ``component_fp`` names the group; ``component_id`` is its smallest
    non-null ``doc_id``, null only if the group has none. Equal fingerprints
    always share a group, those of texts without words included. An empty
    table gives an empty result.
    """
    own = stored(fingerprints(docs, words), "fingerprints")
    prints = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    groups = connected_components(fingerprint_links(prints, distance)).select(
        F.col("node").alias("fp"), "component"
    )
    named = prints.join(groups, "fp", "left").withColumn("component_fp", F.coalesce("component", "fp"))
    named = stored(named.select("fp", "component_fp", "least"), "print-groups")
    least = named.groupBy("component_fp").agg(F.min("least").alias("component_id"))
    labels = named.select("fp", "component_fp").join(least, "component_fp")
    return own.join(labels, "fp").select("doc_id", "fp", "h", "component_fp", "component_id")


def simhash_digest(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits), ``component_id``."""
    found = simhash_groups(docs, words, distance)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """One row of each group, all columns: that with the smallest (``doc_id``, hash of the text), null ids last.

    Rows that repeat an id with different texts are different documents, so a
    text of no other group never goes because of its id. Of rows equal in both,
    the one with the smallest hash of all columns that can be hashed stays.
    Names of other columns do not matter.
    """
    column = {c: F.col(f"`{c}`") for c in docs.columns}
    hashable = [column[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString()]
    rows = docs.select(
        F.struct(*column.values()).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("h"),
        F.xxhash64(*hashable).alias("tie"),
    )
    rows = rows.withColumn("bare", F.col("id").isNull()).withColumn("id", F.coalesce("id", F.lit(0)))
    groups = simhash_groups(docs, words, distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("h")))
    kept = groups.groupBy("component_fp").agg(first.alias("first")).select("first.*")
    found = rows.join(kept, ["bare", "id", "h"]).groupBy("bare", "id", "h").agg(F.min_by("row", "tie").alias("row"))
    return found.select("row.*")

"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Pieces differ only by their length, so the plan is made on the histogram of
lengths, which has at most ``capacity`` entries whatever the input, and then
applied to all pieces by their rank among those of equal length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import stored, text_steps
from tillroll.llm.tokens import PLACES, encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
# A rank among pieces of equal length stays below two to this power.
RANK_BITS = 44
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, places: int = PLACES
) -> DataFrame:
    """Every text as pieces of at most ``capacity`` ids, the end id included.

    Only documents above the capacity are cut. ``nth`` counts the pieces of
    equal length within the task ``part``. Null texts are empty: one piece
    holding the end id. Null and repeated ids keep their rows. Other columns
    are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer, True, places)
        part, last = TaskContext.get().partitionId(), end_id.to_bytes(4, "little")
        seen = [0] * (capacity + 1)
        for batch, texts in text_steps(batches):
            rows = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), tool.encode(texts), strict=True):
                raw += last
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    ids = raw[at : at + 4 * capacity]
                    length = len(ids) // 4
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(ids), part, seen[length]))
                    seen[length] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(cut, PIECES)


def plan_bins(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces per bin, first bin, offset): who goes where.

    Pieces above a third of the capacity come first: the longest left takes the
    longest partner that fits, so that no bin holds more than two of them.
    The rest go, longest first, to the fullest bins that still have room; new
    bins are opened only when none has. A run of bins with equal contents is
    one entry. A run's room at least halves each time pieces enter it, so the
    plan has at most a few hundred thousand rows for any input.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = {}  # free space -> runs of bins (first, count)
    order: list[int] = []
    bins = 0

    def place(length: int, count: int, each: int, first: int, offset: int) -> None:
        rows.append((length, used[length], each, first, offset))
        used[length] += count
        left[length] -= count

    def free(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in rooms:
                rooms[room] = []
                insort(order, room)
            rooms[room].append((first, count))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        at = bisect_right(large, capacity - a) - 1
        if at == len(large) - 1 and left[a] == 1:
            at -= 1
        if at < 0:
            n = left[a]
            place(a, n, 1, bins, 0)
            free(capacity - a, bins, n)
        elif large[at] == a:
            n = left[a] // 2
            place(a, 2 * n, 2, bins, 0)
            free(capacity - 2 * a, bins, n)
        else:
            b = large[at]
            n = min(left[a], left[b])
            place(a, n, 1, bins, 0)
            place(b, n, 1, bins, a)
            free(capacity - a - b, bins, n)
            if not left[b]:
                large.pop(at)
        bins += n
        if not left[a]:
            large.remove(a)

    for s in sorted((n for n, c in left.items() if c), reverse=True):
        while left[s]:
            at = bisect_left(order, s)
            if at == len(order):
                n = -(-left[s] // (capacity // s))
                free(capacity, bins, n)
                bins += n
                continue
            room = order[at]
            first, count = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                order.pop(at)
            each = room // s
            n = min(count, left[s] // each)
            if n:
                place(s, n * each, each, first, capacity - room)
                free(room - each * s, first, n)
            if n < count and left[s]:
                rest = left[s]
                place(s, rest, rest, first + n, capacity - room)
                free(room - rest * s, first + n, 1)
                n += 1
            free(room, first + n, count - n)
    return np.array(sorted(rows), "i8").reshape(-1, 5)


def assign_bins(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Stored pieces with ``sequence_id`` and ``offset``, in as few sequences as found."""
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "piece-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_bins(histogram, capacity)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = (plan[:, 0] << RANK_BITS) | plan[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(firsts, (length << RANK_BITS) | rank, "right") - 1
            chosen = plan[at]
            nth = rank - chosen[:, 1]
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    pa.array(chosen[:, 3] + nth // chosen[:, 2], pa.int64()),
                    pa.array(chosen[:, 4] + nth % chosen[:, 2] * length, pa.int64()),
                ],
                names=[*keep, "sequence_id", "offset"],
            )

    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(assign, PACKED)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, places: int = PLACES
) -> DataFrame:
    """All documents packed: one row per piece. No document: no row.

    ``places`` (a power of two) bounds the chunks whose ids a worker keeps; fewer take less
    memory and more time.
    """
    pieces = stored(cut_documents(docs, tokenizer, capacity, end_id, places), "pieces")
    return assign_bins(pieces, capacity)

"""What filters do to each other in every order, by wide packed counters.

Which filters a text fails is a mask. A mask decides what happens to the text
at each of the ``n! * n`` steps of all orders, so it maps to one big integer
that holds these outcomes in fields of ``FIELD_BITS``. Adding up the integers
of a part's texts adds up all its fields at once; no field can overflow, as
none counts to more than the rows of a table. Unpacking a part's sum gives its
counts in all orders.

Sums are formed within tasks, then over groups of tasks, then over all, and a
task holds the integers of at most ``HELD`` parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.skew import salted_left_join
from tillroll.llm.common import shuffle_partitions

FIELD_BITS = 64
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
# Parts whose sums a task holds at a time.
HELD = 512
WORD_GAP = r"[\x20\x09-\x0D]+"
NAMES = "ABCDE"


def orders(names: str) -> list[str]:
    return ["".join(p) for p in permutations(names)]


@cache
def integers(names: str) -> tuple[int, ...]:
    """The integer of each kind of text.

    The kind's low bits are the mask, bit ``i`` for ``names[i]``; the next ones say that the text is good and
    that it is toxic. Fields run by order, step and outcome from the lowest bits on.
    """
    n, places = len(names), permutations(range(len(names)))
    by_step = np.array(list(places))
    out = []
    for kind in range(4 << n):
        mask, good, toxic = kind & ((1 << n) - 1), kind >> n & 1, kind >> (n + 1) & 1
        fails = (mask >> by_step & 1).astype(bool)
        gone = np.cumsum(fails, axis=1) > 0
        before = np.hstack([np.zeros((len(by_step), 1), bool), gone[:, :-1]])
        removed = fails & ~before
        outcomes = [~gone, removed, fails & before, fails & (mask & (mask - 1) == 0), removed & bool(good), removed & bool(toxic)]
        fields = np.stack(outcomes, axis=2).astype("<u8")
        out.append(int.from_bytes(fields.tobytes(), "little"))
    return tuple(out)


def packed_size(names: str) -> int:
    return len(orders(names)) * len(names) * len(OUTCOMES) * FIELD_BITS // 8


def summed(rows: DataFrame, names: str) -> DataFrame:
    """Sums ``part, packed, task`` of rows ``part, kind, n`` (``n`` texts of a kind) or ``part, packed``.

    A part has one row per task, more where a task meets more than ``HELD`` parts.
    """
    size, fresh = packed_size(names), "kind" in rows.columns

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def emptied() -> pa.RecordBatch:
            packed = [x.to_bytes(size, "little") for x in total.values()]
            task = pa.array([TaskContext.get().partitionId()] * len(packed), pa.int32())
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(packed, pa.binary()), task], names=["part", "packed", "task"]
            )
            total.clear()
            return batch

        of = integers(names) if fresh else ()
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for part, what, *n in zip(*columns, strict=True):
                add = of[what] * n[0] if fresh else int.from_bytes(what, "little")
                total[part] = total.get(part, 0) + add
                if len(total) > HELD:
                    yield emptied()
        if total:
            yield emptied()

    order = ["part", "kind", "n"] if fresh else ["part", "packed"]
    return rows.select(order).mapInArrow(step, "part string, packed binary, task int")


def unpacked(sums: DataFrame, names: str) -> DataFrame:
    """One row per part, order and step of rows ``part, packed``, one per part.

    ``shapley`` is what the step's filter removes, summed over all orders.
    """
    every, n = orders(names), len(names)
    filters = np.array([list(o) for o in every])
    kinds = [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
    kinds += [(name, pa.int64()) for name in (*OUTCOMES, "shapley")]
    schema = pa.schema(kinds)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fields = np.frombuffer(raw, "<u8").astype("i8").reshape(len(every), n, len(OUTCOMES))
                removed = fields[:, :, OUTCOMES.index("removed")]
                shapley = np.zeros((len(every), n), "i8")
                for name in names:
                    shapley[filters == name] = removed[filters == name].sum()
                counts = [fields[:, :, k].ravel() for k in range(len(OUTCOMES))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * shapley.size), pa.array(np.repeat(every, n)),
                        pa.array(np.tile(np.arange(1, n + 1, dtype="i4"), len(every))),
                        *(pa.array(c) for c in counts), pa.array(shapley.ravel()),
                    ],
                    schema=schema,
                )

    return sums.mapInArrow(step, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c, _ in kinds[3:]))


def audit(rows: DataFrame, names: str) -> DataFrame:
    """The audit of rows ``part, kind, n``: ``n`` texts of a part and kind (see ``integers``), any number of rows each."""
    deals = shuffle_partitions(rows.sparkSession)
    # A part's sums go to several tasks first, so that none meets those of all tasks.
    within = summed(rows, names).repartition(deals, "part", F.col("task") % deals)
    return unpacked(single(summed(within, names), names), names)


def single(sums: DataFrame, names: str) -> DataFrame:
    """One row per part: its sums meet in one partition, sorted, so that one integer is held at a time."""
    size = packed_size(names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        total = 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"part": held, "packed": [total.to_bytes(size, "little")]})

        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and held != [part]:
                    yield done()
                    total = 0
                held = [part]
                total += int.from_bytes(raw, "little")
        if held:
            yield done()

    dealt = sums.select("part", "packed").repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(step, "part string, packed binary")


def text_failures(text: Column) -> Sequence[Column]:
    """Conditions A to D: short, repetitive, shouting, with symbols; for a non-null text."""
    words = F.array_remove(F.split(text, WORD_GAP), "")
    shouted = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return (
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * shouted > 3 * F.length(text),
        text.rlike("[#$%&*|]"),
    )


def kinds_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, kind, n`` of all documents: mask of the failures A to E, good and toxic labels.

    Equal texts fail A to D alike, so what is counted per text, part and label
    are its documents, those with the smallest id of their group apart; E then
    needs the smallest id of the text only. Texts are equal if their SHA-256 is.
    """
    text = F.coalesce("text", F.lit(""))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_failures(F.col("_text")))), F.lit(0))
    own = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("_text"))
    rows = own.select("doc_id", "part", F.unhex(F.sha2(F.col("_text"), 256)).alias("key"), mask.cast("int").alias("mask"))
    counted = rows.groupBy("doc_id", "part", "key", "mask").agg(F.count(F.lit(1)).alias("n"))
    told = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
    )
    # Rows without an id meet no label and are spread.
    joined = salted_left_join(counted, told, ["doc_id"], []).fillna(0, ["good", "toxic"])
    known = F.when(F.col("doc_id").isNotNull(), F.col("n"))
    groups = joined.groupBy("key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(known), F.lit(0)).alias("n_known"),
        F.min("doc_id").alias("low"), F.coalesce(F.min_by(known, "doc_id"), F.lit(0)).alias("n_low"),
    )
    # A text has at most four rows per part here, however many copies there are.
    first = F.min("low").over(Window.partitionBy("key"))
    copies = F.col("n_known") - F.when(F.col("low") == F.col("first"), F.col("n_low")).otherwise(0)
    counted = groups.withColumn("first", first).withColumn("copies", copies)
    kind = F.col("mask") + F.col("good") * (1 << len(NAMES)) + F.col("toxic") * (2 << len(NAMES))
    alone, copied = (F.col("n") - F.col("copies")), F.col("copies")
    both = F.array(
        F.struct(kind.alias("kind"), alone.alias("n")), F.struct((kind + (1 << 4)).alias("kind"), copied.alias("n"))
    )
    return counted.select("part", F.inline(both)).filter("n > 0")


def audit_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts per part, order of the five filters and step.

    Null texts and languages are empty. A document labelled more than once is
    good or toxic if one label says so. A row without an id has no label, never
    fails E and makes no other fail; rows that repeat an id and text aren't
    copies of each other. Other columns are ignored, an empty table gives an
    empty result.
    """
    return audit(kinds_of(docs, labels), NAMES)


def digest_sql() -> str:
    """The same counts, from the masks of all documents one by one."""
    failures = "\n      ".join(
        f"sum(n) FILTER (WHERE {what}) AS {name}," for name, what in (
            ("kept", "gone = 0"), ("removed", "fails AND before = 0"), ("redundant", "fails AND before > 0"),
            ("unique_fails", "fails AND mask = bit"), ("good_lost", "fails AND before = 0 AND good"),
            ("toxic_lost", "fails AND before = 0 AND toxic"),
        )
    )
    zeros = ", ".join(f"coalesce({name}, 0)::BIGINT AS {name}" for name in OUTCOMES)
    return f"""
    WITH texts AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
        [w FOR w IN regexp_split_to_array(coalesce(text, ''), '{WORD_GAP}') IF w <> ''] AS words
      FROM documents
    ),
    low AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
    told AS (
      SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
      FROM labels GROUP BY doc_id
    ),
    masks AS (
      SELECT part,
        (len(words) < 200)::INT
        + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
        + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(texts.doc_id > first, false)::INT AS mask,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
      FROM texts JOIN low USING (t) LEFT JOIN told USING (doc_id)
      GROUP BY ALL
    ),
    filters AS (SELECT substr('ABCDE', i::INT, 1) AS name, (1 << (i - 1))::INT AS bit FROM range(1, 6) r(i)),
    steps AS (
      SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
        [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM filters a, filters b, filters c, filters d, filters e
      WHERE len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
    ),
    places AS (
      SELECT filter_order, s::INT AS step, bits[s] AS bit, list_sum(bits[1:s])::INT AS upto
      FROM steps, range(1, 6) r(s)
    ),
    told_all AS (
      SELECT part, filter_order, step, bit, mask, good, toxic, n, mask & bit > 0 AS fails,
        mask & (upto - bit) AS before, mask & upto AS gone
      FROM masks, places
    ),
    counts AS (
      SELECT part, filter_order, step, bit,
      {failures}
      FROM told_all GROUP BY ALL
    )
    SELECT part, filter_order, step, {zeros},
      coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
    FROM counts
    """

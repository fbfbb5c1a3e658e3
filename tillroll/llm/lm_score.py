"""Language-model scores of whole texts: context-tree weighting over bytes.

A byte is eight binary decisions, each in the node its higher bits lead to.
Every decision has a context tree over the bytes before it: a node holds how
often 0 and 1 followed its context in the training texts, and gives a
Krichevsky-Trofimov estimate. A node's weighted probability is half that of
its own counts and half the product of its children's, down to ``DEPTH``
bytes; in a prediction a node's own estimate counts by the share that it has
in its weighted probability, the rest is left to the next longer context. An
unseen node says one half. With the counts held fixed, the probability of a
byte depends on it and the ``DEPTH`` bytes before alone, its *gram*; a text
starts after ``DEPTH`` zero bytes.

Nothing about all texts is held in one place. Each scan partition of the
documents is a *chunk* that names the grams and words in it, with their
training counts; counts are added up per gram and per word over all chunks;
and a chunk gets back what it named, which is never more than it holds. Grams
travel packed: one row for a chunk and a group of contexts, its grams in order
as compressed differences.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import id_remainder, shuffle_partitions, spread_keys, stored, text_steps

DEPTH = 5
# Bytes of recent context shared by the grams of one tree task; shorter contexts are summed over them.
SHARED = 2
# Packed bytes of a group's grams that one task takes from the chunks.
PART_BYTES = 8 << 20
# Byte positions handled together, and distinct grams after which a task folds what it has.
SORTED, FOLDED = 1 << 19, 1 << 20


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id leaves 0 modulo 10; null ids are."""
    return id_remainder(doc_id, 10) == 0


def grams_of(raw: bytes, depth: int = DEPTH) -> np.ndarray:
    """Per byte a key: the byte lowest, then the bytes before it, nearest first, above."""
    n = len(raw)
    padded = np.concatenate([np.zeros(depth, "u1"), np.frombuffer(raw, "u1")]).astype("i8")
    key = padded[depth:].copy()
    for d in range(1, depth + 1):
        key |= padded[depth - d : depth - d + n] << (8 * d)
    return key


def joined_grams(texts: list[bytes], depth: int = DEPTH) -> np.ndarray:
    """The grams of several texts in a row; each starts after zero bytes of its own."""
    pad = b"\0" * depth
    row = np.frombuffer(pad + pad.join(texts), "u1").astype("i8")
    key = row.copy()
    for d in range(1, depth + 1):
        key[d:] |= row[:-d] << (8 * d)
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum([depth, *(sizes[:-1] + depth)])
    at = np.repeat(begins - np.cumsum([0, *sizes[:-1]]), sizes) + np.arange(int(sizes.sum()))
    return key[at]


def gram_blocks(texts: list[bytes]) -> Iterator[np.ndarray]:
    """All grams of the texts, about ``SORTED`` at a time; a long text is taken in slices."""
    held: list[bytes] = []
    size = 0
    for raw in texts:
        if len(raw) >= SORTED:
            for at in range(0, len(raw), SORTED):
                yield grams_of(raw[max(0, at - DEPTH) : at + SORTED])[min(at, DEPTH) :]
            continue
        held.append(raw)
        size += len(raw)
        if size >= SORTED:
            yield joined_grams(held)
            held, size = [], 0
    if size:
        yield joined_grams(held)


class GramTable:
    """Values by gram, found by a hash: where a bucket begins, then one step for each entry before."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(1, (4 * len(keys)).bit_length()))
        bucket = self.bucket(keys)
        order = np.argsort(bucket, kind="stable")
        self.keys = np.append(keys[order], -1)
        self.values = np.append(values[order], 0.0)
        ends = np.cumsum(np.bincount(bucket, minlength=1 << (64 - int(self.shift))))
        self.begin = np.concatenate([[0], ends[:-1]]).astype("i4")

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys.view("u8") * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype("i8")

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys; KeyError for one that isn't there."""
        at = self.begin[self.bucket(keys)]
        wrong = np.flatnonzero(self.keys[at] != keys)
        while len(wrong):
            at[wrong] += 1
            if at[wrong].max() >= len(self.keys):
                raise KeyError("unknown gram")
            wrong = wrong[self.keys[at[wrong]] != keys[wrong]]
        return self.values[at]


def add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sum of their counts."""
    if not keys:
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1 if len(key) else 0))
    return key[first], np.add.reduceat(count, first) if len(first) else count


def pack(values: np.ndarray) -> bytes:
    """8-byte values, their bytes side by side and compressed."""
    rows = np.ascontiguousarray(values).view("u1").reshape(-1, 8)
    return len(values).to_bytes(4, "little") + pa.Codec("zstd").compress(np.ascontiguousarray(rows.T), asbytes=True)


def unpack(raw: bytes, kind: str = "i8") -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    rows = np.frombuffer(pa.Codec("zstd").decompress(raw[4:], 8 * n, asbytes=True), "u1").reshape(8, n)
    return np.ascontiguousarray(rows.T).view(kind).reshape(n)


def pack_keys(key: np.ndarray) -> bytes:
    """Keys in order, as differences."""
    return pack(np.diff(key, prepend=0))


def unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw))


def group_of(key: np.ndarray, groups: int) -> np.ndarray:
    """Grams with the same ``SHARED`` bytes of recent context are in one group."""
    context = (key >> 8 & ((1 << (8 * SHARED)) - 1)).astype("u8")
    return ((context * np.uint64(0x9E3779B1) >> np.uint64(16)) % np.uint64(groups)).astype("i4")


def folded(packed: Iterator[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams in order with the sum of their counts, from packed grams and counts."""
    keys, counts, held, most = [], [], 0, FOLDED
    for grams, n in packed:
        keys.append(unpack_keys(grams))
        counts.append(unpack(n))
        held += len(keys[-1])
        if held > most:
            key, n = add_up(keys, counts)
            keys, counts, held, most = [key], [n], len(key), max(FOLDED, 2 * len(key))
    return add_up(keys, counts)


def words_of(raw: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return raw.lower().split()


def text_mark(texts: list[bytes], out: list[bool]) -> int:
    """A number that changes, but for chance, with any text or with its being held out; it adds up over texts."""
    return sum(xxhash.xxh64_intdigest(raw, seed=is_out) for raw, is_out in zip(texts, out, strict=True)) & (1 << 64) - 1


def chunk_counts(docs: DataFrame) -> DataFrame:
    """Rows (chunk, word or packed grams, training count) for all that occurs in each scan partition.

    ``word`` is null in rows about grams, which hold those of one group
    (``grp``) and their counts packed; a row without word and grams counts the
    training texts and has the mark of all texts in ``counts``.
    """
    groups = 4 * shuffle_partitions(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId()
        words: Counter[bytes] = Counter()
        others: set[bytes] = set()
        keys, counts, held, most, trained, mark = [], [], 0, FOLDED, 0, 0
        for batch, texts in text_steps(batches):
            out = batch.column("out").to_pylist()
            trained += out.count(False)
            mark += text_mark(texts, out)
            for raw, is_out in zip(texts, out, strict=True):
                if is_out:
                    others.update(words_of(raw))
                else:
                    words.update(words_of(raw))
            for weight in (1, 0):
                for grams in gram_blocks([t for t, o in zip(texts, out, strict=True) if o != weight]):
                    key, n = np.unique(grams, return_counts=True)
                    keys.append(key)
                    counts.append(n * weight)
                    held += len(key)
                    if held > most:
                        key, n = add_up(keys, counts)
                        keys, counts, held, most = [key], [n], len(key), max(FOLDED, 2 * len(key))
        key, n = add_up(keys, counts)
        keys, counts = [], []

        def rows(size: int, **given) -> pa.RecordBatch:
            kinds = {"grp": pa.int32(), "word": pa.binary(), "grams": pa.binary(), "counts": pa.binary(), "n": pa.int64()}
            columns = [pa.array(given[c], k) if c in given else pa.nulls(size, k) for c, k in kinds.items()]
            return pa.RecordBatch.from_arrays([pa.array(np.full(size, chunk, "i4")), *columns], names=["chunk", *kinds])

        group = group_of(key, groups)
        order = np.argsort(group, kind="stable")
        group, key, n = group[order], key[order], n[order]
        begins = np.flatnonzero(np.diff(group, prepend=-1))
        ends = [*begins[1:].tolist(), len(group)]
        parts = list(zip(begins.tolist(), ends, strict=False))
        for at in range(0, len(parts), 64):
            some = parts[at : at + 64]
            yield rows(
                len(some), grp=[int(group[a]) for a, _ in some], grams=[pack_keys(key[a:b]) for a, b in some],
                counts=[pack(n[a:b]) for a, b in some],
            )
        for word in others - words.keys():
            words[word] = 0
        found, step = list(words), 1 << 16
        for at in range(0, len(found), step):
            part = found[at : at + step]
            yield rows(len(part), word=part, n=[words[w] for w in part])
        yield rows(1, n=[trained], counts=[(mark & (1 << 64) - 1).to_bytes(8, "little")])

    return docs.select("text", "out").mapInArrow(
        count, "chunk int, grp int, word binary, grams binary, counts binary, n long"
    )


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving the argument up by 8."""
    y = x + 8
    shift = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) + 1 / (1188 * y**9)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones, in any order."""
    both = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0)
    return both - math.log(math.pi)


def node_counts(key: np.ndarray, n: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes (context, then the bits above the decision) at ``depth`` with zeros and ones that followed."""
    seen = n > 0
    key, n = key[seen], n[seen]
    context, byte = (key >> 8) & ((1 << (8 * depth)) - 1), key & 255
    nodes, ones, every = [], [], []
    for b in range(8):
        nodes.append(context << 8 | 1 << b | byte >> (8 - b))
        ones.append(n * (byte >> (7 - b) & 1))
        every.append(n)
    node, total = add_up(nodes, every)
    _, one = add_up(nodes, ones)
    return node, total - one, one


def weigh(node, zeros, ones, below) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of nodes, and the share that their own estimate has in it.

    ``below`` is the sum over their children, None for the longest contexts.
    """
    own = log_kt(zeros, ones)
    if below is None:
        return own, np.ones(len(node))
    both = np.logaddexp(own, below) - math.log(2)
    return both, np.exp(own - math.log(2) - both)


def parents(node: np.ndarray, depth: int) -> np.ndarray:
    """The node one byte shorter of each node at ``depth``."""
    return node & ((1 << (8 * depth)) - 1)


def climb(node, zeros, ones, logs, depth):
    """Nodes at ``depth - 1`` with their counts and the sums over their children."""
    up = parents(node, depth)
    key, z = add_up([up], [zeros])
    _, o = add_up([up], [ones])
    _, below = add_up([up], [logs])
    return key, z, o, below


def subtree(key: np.ndarray, n: np.ndarray, depth: int, top: int) -> list[tuple]:
    """Per depth from ``depth`` down to ``top``: nodes, zeros, ones, log probability, own share."""
    node, zeros, ones = node_counts(key, n, depth)
    logs, share = weigh(node, zeros, ones, None)
    out = [(node, zeros, ones, logs, share)]
    for d in range(depth, top, -1):
        node, zeros, ones, below = climb(node, zeros, ones, logs, d)
        logs, share = weigh(node, zeros, ones, below)
        out.append((node, zeros, ones, logs, share))
    return out


def gram_logs(key: np.ndarray, levels: list[tuple], depth: int) -> np.ndarray:
    """Log10 probability of the byte of each gram; ``levels`` from the longest context to none."""
    total = np.zeros(len(key))
    byte = key & 255
    for b in range(8):
        bits = 1 << b | byte >> (8 - b)
        one = (byte >> (7 - b) & 1).astype(bool)
        p = np.full(len(key), 0.5)
        for d, (node, zeros, ones, _, share) in zip(range(depth, -1, -1), levels, strict=True):
            if not len(node):
                continue
            want = ((key >> 8) & ((1 << (8 * d)) - 1)) << 8 | bits
            at = np.minimum(np.searchsorted(node, want), len(node) - 1)
            seen = node[at] == want
            own = (np.where(one, ones[at], zeros[at]) + 0.5) / (zeros[at] + ones[at] + 1.0)
            p = np.where(seen, share[at] * own + (1 - share[at]) * p, 0.5)
        total += np.log10(p)
    return total


def dealt_groups(counted: DataFrame) -> DataFrame:
    """Rows about grams with ``part``: the chunks of a group of more than ``PART_BYTES`` are dealt into ``parts`` parts."""
    rows = counted.select("grp", "chunk", "grams", "counts")
    size = F.sum(F.length("grams") + F.length("counts"))
    parts = rows.groupBy("grp").agg(F.ceil(size / F.lit(PART_BYTES)).cast("int").alias("parts"))
    # One row per group: Spark broadcasts them below its limit and shuffles them above it.
    return rows.join(parts, "grp").withColumn("part", F.pmod(F.hash("chunk"), F.col("parts")))


def distinct_grams(dealt: DataFrame) -> DataFrame:
    """``grp, parts, grams, counts``: one row per group, its distinct grams with the sum of their counts."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: dict[str, int] = {}

        def packed() -> Iterator[tuple[bytes, bytes]]:
            for batch in batches:
                told.update({c: batch.column(c)[0].as_py() for c in ("grp", "parts")})
                yield from zip(batch.column("grams").to_pylist(), batch.column("counts").to_pylist(), strict=True)

        key, n = folded(packed())
        columns = [pa.array([told["grp"]], pa.int32()), pa.array([told["parts"]], pa.int32())]
        columns += [pa.array([raw], pa.binary()) for raw in (pack_keys(key), pack(n))]
        yield pa.RecordBatch.from_arrays(columns, names=["grp", "parts", "grams", "counts"])

    kind = "grp int, parts int, grams binary, counts binary"
    columns = ("grp", "part", "parts", "grams", "counts")
    once = dealt.select(*columns).groupBy("grp", "part").applyInArrow(fold, kind)
    several = once.filter("parts > 1").groupBy("grp").applyInArrow(fold, kind)
    return once.filter("parts = 1").unionByName(several)


def gram_model(counted: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``chunk, grams, logs`` for rows ``chunk, grp, grams, counts``: log10 probabilities beside the grams, packed.

    A count may be 0: a gram to be scored only. Counts are folded per part of a
    group, then per group, so no task holds what all chunks say about a
    context. The tree is built per ``SHARED`` bytes of recent context from the
    distinct grams. The nodes above are at most 256 contexts of 255 decisions,
    and are all that meets on the driver, however long the texts are.
    """
    dealt = dealt_groups(counted)
    distinct = stored(distinct_grams(dealt), "gram-counts")

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grams, counts in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                node, zeros, ones, logs, _ = subtree(unpack_keys(grams), unpack(counts), depth, SHARED)[-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (node, zeros, ones, logs)], names=["node", "zeros", "ones", "logs"]
                )

    shared = distinct.select("grams", "counts").mapInArrow(tops, "node long, zeros long, ones long, logs double")
    shorter = shared.groupBy(F.col("node").bitwiseAND(F.lit((1 << (8 * SHARED)) - 1)).alias("node"))
    found = shorter.agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("logs").alias("below")
    ).toPandas().sort_values("node")
    node, zeros, ones = (found[c].to_numpy("i8") for c in ("node", "zeros", "ones"))
    logs, share = weigh(node, zeros, ones, found["below"].to_numpy("f8"))
    above = [(node, zeros, ones, logs, share)]
    for d in range(SHARED - 1, 0, -1):
        node, zeros, ones, below = climb(node, zeros, ones, logs, d)
        logs, share = weigh(node, zeros, ones, below)
        above.append((node, zeros, ones, logs, share))

    def score(named: pa.Table, model: pa.Table) -> pa.Table:
        key, n = unpack_keys(model["grams"][0].as_py()), unpack(model["counts"][0].as_py())
        levels = [*subtree(key, n, depth, SHARED), *above]
        logs = np.concatenate(
            [gram_logs(key[at : at + SORTED], levels, depth) for at in range(0, len(key), SORTED)] or [np.zeros(0)]
        )
        del levels, n
        told = [pack(logs[np.searchsorted(key, unpack_keys(grams.as_py()))]) for grams in named["grams"]]
        return pa.table({"chunk": named["chunk"], "grams": named["grams"], "logs": pa.array(told, pa.binary())})

    models = distinct.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    named = dealt.select("grp", "part", "chunk", "grams").groupBy("grp", "part")
    return named.cogroup(models.select("grp", "part", "grams", "counts").groupBy("grp", "part")).applyInArrow(
        score, "chunk int, grams binary, logs binary"
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    ``docs`` must be a stored table, perhaps filtered: its scan partitions are
    the chunks and are the same in both passes (anything else raises).

    ``score`` is the context-tree log10 probability of the text's bytes;
    ``code_bits_per_byte`` the code length that follows, null for an empty
    text. ``base_score`` smooths word counts. Null texts are empty: one end
    token, score 0. Null and repeated ids keep their rows. Other columns are
    ignored, an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("out"))
    counted = stored(chunk_counts(rows), "chunk-counts")
    grams, words = counted.filter("grams is not null"), counted.filter("word is not null")
    word_counts = stored(words.groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    texts = counted.filter("grams is null and word is null")
    ends = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n, v = word_counts.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n, v = int(n) + int(ends), int(v) + (ends > 0)
    # What a chunk named: packed grams with their values, a word with its count, the number of texts.
    nothing, none = F.lit(None).cast("binary"), F.lit(None).cast("double")
    named = (
        gram_model(grams).select("chunk", nothing.alias("word"), "grams", "logs", none.alias("value"))
        .unionByName(
            words.select("chunk", "word").join(word_counts.filter("c > 0"), "word")
            .select("chunk", "word", nothing.alias("grams"), nothing.alias("logs"), F.col("c").cast("double").alias("value"))
        )
        .unionByName(
            texts.select(
                "chunk", nothing.alias("word"), nothing.alias("grams"), F.col("counts").alias("logs"), F.col("n").cast("double").alias("value")
            )
        )
    )
    scored = rows.withColumn("chunk", F.spark_partition_id())
    floor = n + 0.1 * (v + 1)
    low, end = math.log10(0.1 / floor), math.log10((ends + 0.1) / floor)

    def score(docs: pa.Table, told: pa.Table) -> pa.Table:
        out = docs["out"].to_pylist()
        word, gram = told["word"].is_valid(), told["grams"].is_valid()
        mark = text_mark([t.as_py() or b"" for t in docs["text"].cast(pa.binary())], out).to_bytes(8, "little")
        if told.filter(pc.invert(pc.or_(word, gram)))["logs"].to_pylist() != [mark]:
            raise ValueError("the documents were dealt anew between two passes; store them first")
        about, packed = told.filter(word), told.filter(gram)
        words = np.log10((about["value"].to_numpy() + 0.1) / floor).tolist()
        base = dict(zip(about["word"].to_pylist(), words, strict=True))
        del told, about, words
        keys = [unpack_keys(x.as_py()) for x in packed["grams"]] or [np.zeros(0, "i8")]
        values = [unpack(x.as_py(), "f8") for x in packed["logs"]] or [np.zeros(0)]
        del packed
        logs = GramTable(np.concatenate(keys), np.concatenate(values))
        del keys, values
        rows = []
        for text in docs["text"].cast(pa.binary()):
            raw = text.as_py() or b""
            found = words_of(raw)
            seen = [v for v in map(base.get, found) if v is not None]
            unseen = len(found) - len(seen)
            total = 0.0
            for at in range(0, len(raw), SORTED):
                want = grams_of(raw[max(0, at - DEPTH) : at + SORTED])[min(at, DEPTH) :]
                total += float(logs.of(want).sum())
            bits = -total * math.log2(10) / len(raw) if raw else None
            rows.append((len(found) + 1, len(seen) + (ends > 0), math.fsum(seen) + unseen * low + end, total, bits))
        tokens, known, base_score, total, bits = zip(*rows, strict=True) if rows else ((),) * 5
        return pa.table(
            {
                "doc_id": docs["doc_id"], "held_out": docs["out"], "n_tokens": pa.array(tokens, pa.int64()),
                "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array([n] * len(rows), pa.int64()),
                "base_score": pa.array(base_score, pa.float64()), "score": pa.array(total, pa.float64()),
                "code_bits_per_byte": pa.array(bits, pa.float64()),
            }
        )

    kind = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, code_bits_per_byte double"
    )
    # A chunk is large, so chunks are dealt evenly; there are as many as scan tasks, one row each.
    keys = stored(spread_keys(docs.sparkSession, scored.rdd.getNumPartitions()), "chunk-keys")
    scored = scored.join(F.broadcast(keys), "chunk").drop("chunk")
    named = named.join(F.broadcast(keys.withColumnRenamed("key", "of_key")), "chunk").drop("chunk")
    return scored.groupBy("key").cogroup(named.groupBy("of_key")).applyInArrow(score, kind)

"""Alignment of two tokenizers' tokens, and which ids they link, by diagonal run skipping.

Both token rows of a text spell the same bytes, so they are two increasing
rows of end offsets. Offsets where both have an end cut the text into groups.
As long as tokens match one to one, the end of token ``i`` on one side is that
of token ``i + shift`` on the other; the two arrays are compared at the present
shift in stretches of 1, 2, 4, ... tokens, whole stretches at once, and a
stretch that fails is halved until the first difference is found. There a group
of unequal sizes is resolved token by token, and the shift is updated.

Each common end links the two tokens that end there. How often a pair of ids is
linked is counted over all documents: a chunk of documents names its distinct
pairs once, the counts are added up by pair, and each chunk gets back those of
its own pairs.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import stored, text_steps
from tillroll.llm.tokens import ChunkEncoder, IdTable

# Text of one chunk: its documents' links are held together.
CHUNK_BYTES = 16 << 20
# Groups hashed together, uneven groups remembered, and places of the tables of chunks seen.
HASHED, UNEVEN, REMEMBERED = 1 << 14, 1 << 17, 1 << 20

_tokenizers: dict[tuple[str, str], TokenizerPair] = {}


class PieceEncoder(ChunkEncoder):
    """Encodes with a sentence-piece model what follows its added space.

    No piece of the model holds a line break, and none a white space other
    than a carriage return behind a visible character, so chunks are encoded
    apart; texts with a carriage return are encoded as a whole.
    """

    def __init__(self, path: str, places: int):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.lower = False
        self.table = IdTable(places, "u2" if self.model.get_piece_size() <= 1 << 16 else "u4")

    def ids(self, raw: bytes) -> list[int]:
        # The model's own space and the line break are its first two tokens.
        return self.model.encode("\n" + raw.decode())[2:]

    def encode(self, raws: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(raws)
        plain = [i for i, raw in enumerate(raws) if b"\r" not in raw]
        for i, ids in zip(plain, super().encode([raws[i] for i in plain]), strict=True):
            out[i] = ids
        for i, raw in enumerate(raws):
            if b"\r" in raw:
                out[i] = np.array(self.ids(raw), "<u4").tobytes()
        return out


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes are their own letter; the others take the letters from
    256 on, in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenizerPair:
    """Both tokenizers with the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = ChunkEncoder(path_a, False, REMEMBERED)
        self.a.tokenizer.encode_special_tokens = True
        self.b = PieceEncoder(path_b, REMEMBERED)
        letter, model = byte_letters(), self.b.model
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=True)
        of_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            of_a[i] = bytes(letter[c] for c in token) if all(c in letter for c in token) else token.encode()
        of_b = [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())
        ]
        self.bytes_a, self.bytes_b = of_a, of_b
        self.size_a, self.size_b = (np.array([len(x) for x in of], "u4") for of in (of_a, of_b))

    def encode(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Both rows of ids per text; empty ones where the texts spelled differ from a space and the text."""
        spaced = [b" " + t if t else b"" for t in texts]
        nothing = np.zeros(0, "<u4")
        for text, a, b in zip(spaced, self.a.encode(spaced), self.b.encode(spaced), strict=True):
            ids_a, ids_b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
            same = all(
                b"".join(map(of.__getitem__, ids.tolist())) == text
                for of, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))
            )
            yield (ids_a, ids_b) if same else (nothing, nothing)


def tokenizer_pair(path_a: str, path_b: str) -> TokenizerPair:
    """One pair per worker process, kept between tasks."""
    if (path_a, path_b) not in _tokenizers:
        _tokenizers[path_a, path_b] = TokenizerPair(path_a, path_b)
    return _tokenizers[path_a, path_b]


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The groups that are not one token each, as ``a, a_end, b, b_end``, of two rows of end offsets with the same last one.

    All tokens between them match one to one.
    """
    raw_a, raw_b = ends_a.astype("<u4").tobytes(), ends_b.astype("<u4").tobytes()
    n, m = len(raw_a), len(raw_b)
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    out = []
    # Places in bytes; their difference is the present shift.
    i = j = 0
    while i < n:
        step = 4
        while raw_a[i : i + step] == raw_b[j : j + step] and i + step <= n and j + step <= m:
            i += step
            j += step
            step += step
        while step > 4:
            step >>= 1
            if raw_a[i : i + step] == raw_b[j : j + step] and i + step <= n and j + step <= m:
                i += step
                j += step
        if i < n:
            a, b = p, q = i >> 2, j >> 2
            end_a, end_b = list_a[a], list_b[b]
            while end_a != end_b:
                if end_a < end_b:
                    a += 1
                    end_a = list_a[a]
                else:
                    b += 1
                    end_b = list_b[b]
            a += 1
            b += 1
            out.append((p, a, q, b))
            i, j = a << 2, b << 2
    return out


@dataclass(frozen=True)
class Alignment:
    """The last token of each group on both sides; groups of more than one token each side, and which ones they are."""

    last_a: np.ndarray
    last_b: np.ndarray
    uneven: list[tuple[int, int, int, int]]
    places: list[int]


def align_ids(ids_a: np.ndarray, ids_b: np.ndarray, pair: TokenizerPair) -> Alignment:
    if not len(ids_a):
        return Alignment(np.zeros(0, "i8"), np.zeros(0, "i8"), [], [])
    uneven = align(np.cumsum(pair.size_a[ids_a], dtype="u4"), np.cumsum(pair.size_b[ids_b], dtype="u4"))
    a, a_end, b, b_end = np.array(uneven, "i8").reshape(-1, 4).T
    last_a, last_b = last_tokens(len(ids_a), a, a_end), last_tokens(len(ids_b), b, b_end)
    return Alignment(last_a, last_b, uneven, np.searchsorted(last_a, a_end - 1).tolist())


def last_tokens(n: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Places of the tokens that end a group, where the groups of several tokens are ``begin:end``."""
    inside = np.zeros(n, "i1")
    inside[begin] += 1
    inside[end - 1] -= 1
    return np.flatnonzero(np.cumsum(inside, dtype="i1") == 0)


class Links(dict):
    """Pairs of linked ids, each as ``a * width + b``, numbered as they come, with a group of just these two written out."""

    def __init__(self, width: int):
        super().__init__()
        self.width = width
        self.written: list[str] = []
        self.uneven: dict[tuple[bytes, bytes], str] = {}

    def __missing__(self, pair: int) -> int:
        self[pair] = number = len(self)
        self.written.append("%d|%d" % divmod(pair, self.width))
        return number

    def uneven_group(self, a: bytes, b: bytes) -> str:
        key = a, b
        if key not in self.uneven:
            if len(self.uneven) >= UNEVEN:
                self.uneven.clear()
            self.uneven[key] = "|".join(",".join(map(str, np.frombuffer(x, "<u4").tolist())) for x in key)
        return self.uneven[key]

    def of(self, ids_a: np.ndarray, ids_b: np.ndarray, found: Alignment) -> tuple[list[int], str]:
        """Numbers of a text's links, and the SHA-256 of its groups written out ('' without any)."""
        pairs = ids_a[found.last_a].astype("i8") * self.width + ids_b[found.last_b]
        numbers = list(map(self.__getitem__, pairs.tolist()))
        if not numbers:
            return numbers, ""
        raw_a, raw_b = ids_a.tobytes(), ids_b.tobytes()
        groups = list(map(self.written.__getitem__, numbers))
        for place, (a, a_end, b, b_end) in zip(found.places, found.uneven, strict=True):
            groups[place] = self.uneven_group(raw_a[4 * a : 4 * a_end], raw_b[4 * b : 4 * b_end])
        hashed = hashlib.sha256()
        for at in range(0, len(groups), HASHED):
            hashed.update(((";" if at else "") + ";".join(groups[at : at + HASHED])).encode())
        return numbers, hashed.hexdigest()


def aligned(docs: DataFrame, path_a: str, path_b: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with both rows of ids, and the tokens before the end of each group.

    ``a_ids`` come from a byte-level tokenizer file and ``b_ids`` from a
    sentence-piece model, both of a space and the text, special strings being
    plain text. Null and empty texts, and texts that one of the tokenizers
    does not spell as they are, have no tokens.
    """
    rows = docs.select(*keep, F.col("text").alias("_text"))
    names = ("a_ids", "b_ids", "a_upto", "b_upto")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(path_a, path_b)
        for batch, texts in text_steps(batches, len(keep)):
            out: list[list] = [[], [], [], []]
            for ids_a, ids_b in pair.encode(texts):
                found = align_ids(ids_a, ids_b, pair)
                for column, row in zip(out, (ids_a, ids_b, found.last_a + 1, found.last_b + 1), strict=True):
                    column.append(row)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays = [pa.array(c, pa.list_(pa.int32())) for c in out]
            yield pa.RecordBatch.from_arrays([*columns, *arrays], names=[*keep, *names])

    return rows.mapInArrow(step, ", ".join([*kinds, *(f"{n} array<int>" for n in names)]))


DOCUMENT = ("doc_id long", "n_a long", "n_b long", "n_groups long", "groups_sha256 string", "links binary")


def chunk_links(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents with the numbers of their links in their chunk, and the chunk's pairs by number with their counts.

    A pair is one value, ``a * |B| + b``.
    """
    document = pa.schema(
        [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
         ("groups_sha256", pa.string()), ("links", pa.binary())]
    )
    counted = pa.schema([("pair", pa.int64()), ("place", pa.int64()), ("n", pa.int64())])
    schema = pa.schema([("chunk", pa.int64()), *document, *counted])

    def rows_of(chunk: int, size: int, columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
        full = [columns.get(f.name, pa.nulls(size, f.type)) for f in schema]
        full[0] = pa.array(np.full(size, chunk))
        batch = pa.RecordBatch.from_arrays(full, schema=schema)
        for at in range(0, size, 1 << 14):
            yield batch.slice(at, 1 << 14)

    def flush(chunk: int, held: list[tuple], links: Links) -> Iterator[pa.RecordBatch]:
        width = "<u2" if len(links) <= 1 << 16 else "<u4"
        counts = np.zeros(len(links), "i8")
        for at in range(0, len(held), 1 << 12):
            part = held[at : at + (1 << 12)]
            counts += np.bincount(np.concatenate([np.frombuffer(h[-1], "<u4") for h in part]), minlength=len(links))
            columns = dict(zip(document.names, zip(*part, strict=True), strict=True))
            columns["links"] = [np.frombuffer(x, "<u4").astype(width).tobytes() for x in columns["links"]]
            yield from rows_of(chunk, len(part), {k: pa.array(v, document.field(k).type) for k, v in columns.items()})
        numbers = {"pair": np.fromiter(links, "i8", len(links)), "place": np.arange(len(links)), "n": counts}
        yield from rows_of(chunk, len(links), {k: pa.array(v) for k, v in numbers.items()})

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(path_a, path_b)
        links = Links(len(pair.bytes_b))
        chunk, size = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []
        for batch, texts in text_steps(batches, 1):
            for doc_id, text, (a, b) in zip(batch.column(0).to_pylist(), texts, pair.encode(texts), strict=True):
                found = align_ids(a, b, pair)
                numbers, digest = links.of(a, b, found)
                held.append((doc_id, len(a), len(b), len(numbers), digest, np.array(numbers, "<u4").tobytes()))
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield from flush(chunk, held, links)
                    chunk, size, held, links = chunk + 1, 0, [], Links(links.width)
        if held:
            yield from flush(chunk, held, links)

    return rows.mapInArrow(step, ", ".join(["chunk long", *DOCUMENT, "pair long", "place long", "n long"]))


def alignment_digest(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document its tokens, groups and links, and how its links stand among those of all documents.

    ``count_sum`` adds up, over a document's links, how often the linked pair
    of ids is linked in all documents; ``n_best`` counts the links whose pair
    is the most frequent one of its second id, ties included. Null and repeated
    ids keep their rows and count each; other columns are ignored; an empty
    table gives an empty result. Texts without tokens have zeros and ''.
    """
    from sentencepiece import SentencePieceProcessor

    width = SentencePieceProcessor(model_file=path_b).get_piece_size()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(chunk_links(rows, path_a, path_b), "token-links")
    pairs = found.filter("pair is not null").select("chunk", "pair", "place", "n")
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    # One id has at most as many partners as the other vocabulary has ids.
    of_id = Window.partitionBy(F.pmod("pair", F.lit(width)))
    ranked = totals.withColumn("best", F.col("total") == F.max("total").over(of_id))
    told = pairs.join(ranked, "pair").select(F.col("chunk").alias("of_chunk"), "place", "total", "best")
    documents = found.filter("pair is null").select("chunk", *(c.split()[0] for c in DOCUMENT))

    def score(docs: pa.Table, told: pa.Table) -> pa.Table:
        order = np.argsort(told["place"].to_numpy())
        total, best = told["total"].to_numpy()[order], told["best"].to_numpy()[order]
        each = "<u2" if len(order) <= 1 << 16 else "<u4"
        links = [np.frombuffer(x.as_py(), each) for x in docs["links"]]
        return pa.table(
            {
                "doc_id": docs["doc_id"], "n_a": docs["n_a"], "n_b": docs["n_b"], "n_groups": docs["n_groups"],
                "n_links": pa.array([len(x) for x in links], pa.int64()),
                "n_best": pa.array([int(best[x].sum()) for x in links], pa.int64()),
                "count_sum": pa.array([int(total[x].sum()) for x in links], pa.int64()),
                "groups_sha256": docs["groups_sha256"],
            }
        )

    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return documents.groupBy("chunk").cogroup(told.groupBy("of_chunk")).applyInArrow(score, kind)

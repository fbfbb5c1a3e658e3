"""Token ids in length-delimited binary records with an offset index.

One shard is a pair of files. ``*.rec`` holds records back to back:

    8 bytes  length n of the payload, little-endian unsigned
    4 bytes  masked CRC-32 of those 8 bytes
    n bytes  payload: document id (8, signed), flags (1), ids (2 or 4 bytes each)
    4 bytes  masked CRC-32 of the payload

Flag 1 marks a null document id, flag 2 ids of two bytes. A masked checksum
is the CRC rotated right by 15 bits plus a constant, so that a checksum stored
inside checked data doesn't confirm itself. ``*.idx`` holds, for each record
and after the last, the byte offset and the number of ids before it (8 bytes
each), which is all a shuffled read needs.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import stored, text_steps
from tillroll.llm.tokens import encoder
from tillroll.session import scratch_path

MASK = 0xA282EAD8
HEAD, CHECK, BODY = "<Q", "<I", "<qB"
NULL_ID, SHORT_IDS = 1, 2
WRITE_BYTES, READ_BYTES = 8 << 20, 8 << 20
MANIFEST = "shard int, records string, index string, n_records long, n_ids long"


def masked(raw: bytes) -> int:
    crc = zlib.crc32(raw)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack(HEAD, len(payload))
    return b"".join((head, struct.pack(CHECK, masked(head)), payload, struct.pack(CHECK, masked(payload))))


def unframe(raw: bytes, at: int = 0) -> bytes:
    """The payload of the record at byte ``at``; ValueError if a checksum is wrong."""
    head = raw[at : at + 8]
    (n,) = struct.unpack(HEAD, head)
    payload = raw[at + 12 : at + 12 + n]
    sums = (raw[at + 8 : at + 12], raw[at + 12 + n : at + 16 + n])
    if sums != (struct.pack(CHECK, masked(head)), struct.pack(CHECK, masked(payload))):
        raise ValueError(f"damaged record at byte {at}")
    return payload


def payload_of(doc_id: int | None, ids: np.ndarray, short: bool) -> bytes:
    flags = (doc_id is None) * NULL_ID | short * SHORT_IDS
    return struct.pack(BODY, doc_id or 0, flags) + ids.astype("<u2" if short else "<u4").tobytes()


def sequence_of(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags = struct.unpack_from(BODY, payload)
    ids = np.frombuffer(payload, "<u2" if flags & SHORT_IDS else "<u4", offset=struct.calcsize(BODY))
    return None if flags & NULL_ID else doc_id, ids.astype("<u4")


def read_record(records: str, index: str, i: int) -> tuple[int | None, np.ndarray]:
    """Record ``i`` of a shard by two small reads."""
    fs, path = pafs.FileSystem.from_uri(index)
    with fs.open_input_file(path) as f:
        f.seek(16 * i)
        (begin, _), (end, _) = struct.iter_unpack("<QQ", f.read(32))
    fs, path = pafs.FileSystem.from_uri(records)
    with fs.open_input_file(path) as f:
        f.seek(begin)
        return sequence_of(unframe(f.read(end - begin)))


def write_records(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0) -> DataFrame:
    """Shards of all texts in ascending ``doc_id`` order; returns the manifest.

    Null texts are empty and become the end id alone; null ids come first;
    equal ids follow the hash of their text. Columns other than ``doc_id`` and
    ``text`` are ignored. A task writes below a name of its own and only the
    names of tasks that succeeded are in the manifest, so that retries and
    lost executors leave no trace in it. No document: an empty manifest.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer, lower=False)
        short = max(tool.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        last = struct.pack(CHECK, end_id)
        shard = TaskContext.get().partitionId()
        name = f"{folder.rstrip('/')}/shard-{shard:06d}-{uuid.uuid4().hex}"
        fs = out = None
        index, held, at, n = [], [], 0, 0
        for batch, texts in text_steps(batches):
            if out is None:
                fs, path = pafs.FileSystem.from_uri(name)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(f"{path}.rec")
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), tool.encode(texts), strict=True):
                ids = np.frombuffer(raw + last, "<u4")
                record = frame(payload_of(doc_id, ids, short))
                index.append((at, n))
                held.append(record)
                at += len(record)
                n += len(ids)
            if sum(map(len, held)) >= WRITE_BYTES:
                out.write(b"".join(held))
                held = []
        if out is not None:
            out.write(b"".join(held))
            out.close()
            with fs.open_output_stream(f"{path}.idx") as f:
                f.write(np.array([*index, (at, n)], "<u8").tobytes())
            row = {"shard": [shard], "records": [f"{name}.rec"], "index": [f"{name}.idx"]}
            yield pa.RecordBatch.from_pydict(
                row | {"n_records": [len(index)], "n_ids": [n]},
                pa.schema([("shard", pa.int32()), ("records", pa.string()), ("index", pa.string()),
                           ("n_records", pa.int64()), ("n_ids", pa.int64())]),
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    return stored(ordered.select("doc_id", "text").mapInArrow(write, MANIFEST), "manifest")


def read_records(manifest: DataFrame) -> DataFrame:
    """Every record read back: doc_id, start, n_tokens, ids_crc32, shard, position.

    Each shard is read in blocks of a bounded size and every checksum is tested.
    ``start`` counts the ids of all records before it, over all shards.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = pafs.FileSystem.from_uri(row["index"])
                with fs.open_input_file(path) as f:
                    index = np.frombuffer(f.read(), "<u8").reshape(-1, 2).astype("i8")
                fs, path = pafs.FileSystem.from_uri(row["records"])
                with fs.open_input_file(path) as f:
                    at = 0
                    while at < len(index) - 1:
                        to = max(at + 1, int(np.searchsorted(index[:, 0], index[at, 0] + READ_BYTES, "right")) - 1)
                        base = int(index[at, 0])
                        block = f.read(int(index[to, 0]) - base)
                        found = [sequence_of(unframe(block, int(o) - base)) for o in index[at:to, 0]]
                        sums = [zlib.crc32(ids.tobytes()) for _, ids in found]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([d for d, _ in found], pa.int64()),
                                pa.array(index[at:to, 1] + row["base"], pa.int64()),
                                pa.array([len(ids) for _, ids in found], pa.int64()),
                                pa.array(sums, pa.int64()),
                                pa.array([row["shard"]] * (to - at), pa.int32()),
                                pa.array(range(at, to), pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "position"],
                        )
                        at = to

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    n = max(1, manifest.count())
    return shards.repartition(n, "shard").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, position long"
    )


def records_digest(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Writes all documents below the shared folder and returns what the files hold."""
    folder = scratch_path(docs.sparkSession, "records")
    return read_records(write_records(docs, tokenizer, folder, end_id))

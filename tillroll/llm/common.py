"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import tillroll
from tillroll.session import scratch_path

# Texts handed to one vectorised step.
STEP_BYTES = 4 << 20
# Rows that Spark and its Python workers exchange at once; whole documents are too large for the usual 10,000.
BATCH_ROWS = 2000
# Tables written by this application.
_stored: dict[str, list[str]] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    The Parquet copy cuts the lineage: a lost executor never recomputes what
    lies before it, and values that depend on the run stay what they were.
    ``release`` deletes the copies when the results are written.
    """
    path = scratch_path(df.sparkSession, name)
    _stored.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Deletes all tables that ``stored`` has written in this application; returns how many.

    DataFrames that still read them fail afterwards, so write the results first.
    """
    paths = _stored.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def on_workers(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it, and sizes their batches for texts."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(tillroll.__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: Column, n: int) -> Column:
    """``crc32`` of the id as text modulo ``n``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def text_steps(batches: Iterator[pa.RecordBatch], column: str | int = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as UTF-8, about ``STEP_BYTES`` each (null: empty).

    A single text is never cut, however long it is.
    """
    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        begin = size = 0
        held: list[bytes] = []
        for i in range(batch.num_rows):
            raw = texts[i].as_py() or b""
            held.append(raw)
            size += len(raw)
            if size >= STEP_BYTES:
                yield batch.slice(begin, len(held)), held
                begin, size, held = i + 1, 0, []
        if held:
            yield batch.slice(begin, len(held)), held
    pa.default_memory_pool().release_unused()


def spread_keys(spark: SparkSession, count: int) -> DataFrame:
    """``(chunk, key)``: for chunks 0 to ``count`` - 1 keys that a shuffle deals out evenly.

    Few large groups meet by chance in one partition when they are dealt by a
    hash; of many numbers, those are taken whose hashes go round the
    partitions. Keys are only about balance: any others give the same results.
    """
    parts = shuffle_partitions(spark)
    key = F.col("id").cast("int")
    numbers = spark.range(4 * count + 64 * parts).select(key.alias("key"), F.pmod(F.hash(key), F.lit(parts)).alias("part"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    dealt = numbers.select((nth * parts + F.col("part")).alias("chunk"), "key").filter(F.col("chunk") < count)
    # A chunk that found none, if any, keeps a key of its own.
    chunks = spark.range(count).select(F.col("id").cast("int").alias("chunk"))
    return chunks.join(dealt, "chunk", "left").select("chunk", F.coalesce("key", -F.col("chunk") - 1).alias("key"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

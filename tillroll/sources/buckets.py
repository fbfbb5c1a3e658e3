"""Stage tables stored side by side, so that joining them moves no row.

Both tables are dealt by their common key into the same number of buckets and
sorted there. Rows of a key that holds a large share of the table, and rows
without a key, are dealt over all buckets by a salt that is stored with them;
the other table holds one copy of such a key's row per salt.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.skew import LEAST_SALTS, LINE_ID, hot_keys, with_line_id
from tillroll.session import shared_dir

SALT = "_salt"


@dataclass(frozen=True)
class StoredPair:
    """Catalogue names of two tables bucketed by ``key`` and salt; the right one has one row per key and salt."""

    spark: SparkSession
    left: str
    right: str
    key: str

    def joined(self, left: Sequence[str] | None = None, right: Sequence[str] | None = None) -> DataFrame:
        """``left LEFT JOIN right``, the named columns of each, or all; bucket meets bucket without an exchange."""

        def table(name: str, columns: Sequence[str] | None) -> DataFrame:
            df = self.spark.table(name)
            return df if columns is None else df.select(*dict.fromkeys([self.key, SALT, *columns]))

        return table(self.left, left).join(table(self.right, right), [self.key, SALT], "left").drop(SALT)

    def forget(self) -> None:
        """Takes both tables out of the catalogue; their files stay."""
        for name in (self.left, self.right):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _salts(table: DataFrame, key: str, hot: list, salts: int) -> tuple[Column, Column]:
    """Salt of a left row, and the salts of a right row's copies."""
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in table.columns]), F.lit(salts)).cast("int")
    own = F.when(F.col(key).isNull() | is_hot, spread).otherwise(F.lit(0))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    return own, F.when(is_hot, every).otherwise(F.array(F.lit(0)))


def store_pair(
    left: DataFrame, right: DataFrame, key: str, buckets: int | None = None, hot: list | None = None, base: str | None = None
) -> StoredPair:
    """Writes a stored table and one with a row per ``key`` as a pair for ``joined``.

    ``buckets`` is the number of tasks that a join will have, by default the
    session's shuffle partitions; ``hot`` names the frequent keys when they are
    already known. Files go below ``base``, by default the shared folder.
    """
    spark = left.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    hot = hot_keys(left, key)[key] if hot is None else hot
    lines = with_line_id(left)
    salt, copies = _salts(lines, key, hot, max(LEAST_SALTS, buckets))
    run = uuid.uuid4().hex
    base = (base or shared_dir(spark)).rstrip("/")
    salted = lines.withColumn(SALT, salt)
    tables = {
        "left": salted if LINE_ID in left.columns else salted.drop(LINE_ID),
        "right": right.filter(F.col(key).isNotNull()).withColumn(SALT, F.explode(copies)),
    }
    for side, table in tables.items():
        # Dealt as the buckets are, so that each bucket is one sorted file.
        dealt = table.repartition(buckets, key, SALT)
        writer = dealt.write.bucketBy(buckets, key, SALT).sortBy(key, SALT)
        writer.option("path", f"{base}/{side}-{run}").format("parquet").saveAsTable(f"{side}_{run}")
    return StoredPair(spark, f"left_{run}", f"right_{run}", key)

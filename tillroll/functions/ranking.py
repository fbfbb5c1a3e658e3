"""Exact ranks over a whole table without a one-task sort.

Rows are range-partitioned on the sort key and pinned with their partition
number. Each partition is then ranked on its own and shifted by the row count
of the partitions before it, a table of one row per partition and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import pinned


def _ranged(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    return pinned(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))


def running_count(
    df: DataFrame, order_by: Sequence[Column], weight: str, by: Sequence[str] = ()
) -> DataFrame:
    """Adds ``_upto``, the weight up to and including the row, and ``_total``.

    ``order_by`` must be unique within ``by`` for the result to be repeatable.
    """
    by = list(by)
    ranged = _ranged(df, [*[F.col(c).asc_nulls_first() for c in by], *order_by])
    offsets = ranged.groupBy(*by, "_part").agg(F.sum(weight).alias("_here"))
    before = Window.partitionBy(*by).orderBy("_part")
    offsets = offsets.select(
        *[F.col(c).alias(f"_o_{c}") for c in by],
        F.col("_part").alias("_o_part"),
        (F.sum("_here").over(before) - F.col("_here")).alias("_before"),
        F.sum("_here").over(Window.partitionBy(*by)).alias("_total"),
    )
    inside = Window.partitionBy(*by, "_part").orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, 0
    )
    same = F.col("_part") == F.col("_o_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    return (
        ranged.withColumn("_upto", F.sum(weight).over(inside))
        .join(offsets, same)
        .withColumn("_upto", F.col("_upto") + F.col("_before"))
        .drop("_part", "_o_part", "_before", *[f"_o_{c}" for c in by])
    )


def row_numbers(df: DataFrame, order_by: Sequence[Column], name: str) -> DataFrame:
    """Adds the position 1..n of each row in ``order_by`` order."""
    numbered = running_count(df.withColumn("_one", F.lit(1).cast("bigint")), order_by, "_one")
    return numbered.withColumn(name, F.col("_upto").cast("bigint")).drop("_upto", "_total", "_one")


def value_counts(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """``(by..., value, n)`` of the non-missing values.

    Equal values meet in the map-side combine, so a hot group shrinks to its
    distinct values before anything is shuffled.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    x = F.col(value).cast("double")
    return (
        df.filter(x.isNotNull() & ~F.isnan(x))
        .groupBy(*by, x.alias("value"))
        .agg(n.cast("bigint").alias("n"))
    )

"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.01
LEAST_SALTS = 32

# Column that tells equal lines apart while they are spread over salts.
LINE_ID = "_line"


def with_line_id(df: DataFrame) -> DataFrame:
    """Adds ``_line``, unless the lines carry an id of their own.

    For tables straight from storage: a retried task reads its split in the
    same order and gives every row the same number again.
    """
    if LINE_ID in df.columns or "order_item_id" in df.columns:
        return df
    return df.withColumn(LINE_ID, F.monotonically_increasing_id())


def hot_keys(df: DataFrame, *keys: str, share: float = HOT_SHARE) -> dict[str, list]:
    """Values holding more than ``share`` of the rows, per key column.

    One pass without a shuffle. At most ``1 / share`` values come back per
    column; a false positive costs a few copied rows and never a wrong result.
    """
    row = df.select(*keys).stat.freqItems(list(keys), share).first()
    return {k: [v for v in (row[i] or []) if v is not None] for i, k in enumerate(keys)}


def salted_left_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], hot: list, salts: int | None = None
) -> DataFrame:
    """``left LEFT JOIN right`` on ``on``, hot values of ``on[0]`` spread out.

    ``right`` has one row per key. Rows of ``left`` with a hot key go to
    ``salts`` shuffle partitions by a hash of the row, which a retried task
    repeats exactly; only the hot rows of ``right`` are copied to match. Rows
    without a key match nothing and are spread the same way, without copies. There
    are as many salts as shuffle partitions unless given, so a key with a
    third of the rows fills the cluster evenly; keys below the hot share are
    left to the adaptive skew join. Equal
    rows share a salt, so tables that may hold many copies of one row need a
    line id (``with_line_id``).
    """
    on = list(on)
    if salts is None:
        configured = left.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
        salts = max(LEAST_SALTS, int(configured))
    is_hot = F.col(on[0]).isin(hot) if hot else F.lit(False)
    bare = F.col(on[0]).isNull()
    for c in on[1:]:
        bare = bare | F.col(c).isNull()
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_left = left.withColumn("_salt", F.when(bare | is_hot, spread).otherwise(F.lit(0)))
    # Exploded even without copies: a salt known to be 0 would be optimised away.
    copies = F.when(is_hot, every).otherwise(F.array(F.lit(0)))
    salted_right = right.withColumn("_salt", F.explode(copies))
    return salted_left.join(salted_right, [*on, "_salt"], "left").drop("_salt")

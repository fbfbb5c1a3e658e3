"""Measures that read the same from the line fact and from its roll-ups.

A roll-up carries ``line_count`` and ``sales``; the line fact has one row per
line and ``line_total``. Reports written with these helpers accept either, and
from a roll-up they never touch the lines again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import ratio, total


def line_count(df: DataFrame) -> Column:
    if "line_count" in df.columns:
        return F.coalesce(F.sum("line_count"), F.lit(0)).cast("bigint")
    return F.count(F.lit(1))


def sales(df: DataFrame) -> Column:
    return total("sales" if "sales" in df.columns else "line_total")


def order_count(df: DataFrame) -> Column:
    """Distinct orders; a roll-up by order has one row for each."""
    if "order_count" in df.columns:
        return F.coalesce(F.sum("order_count"), F.lit(0)).cast("bigint")
    if {"line_count", "order_id"} <= set(df.columns):
        return F.count(F.lit(1))
    return F.count_distinct("order_id")


def line_mean(df: DataFrame, c: str) -> Column:
    """Mean over lines, not over the rows of a roll-up."""
    if "line_count" not in df.columns:
        return F.avg(c)
    present = F.when(F.col(c).isNotNull(), F.col("line_count"))
    return ratio(F.sum(F.col(c) * F.col("line_count")), F.sum(present))

"""Checks on table shape: columns, row totals, written copies and profiles."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.functions.columns import to_metrics
from tillroll.functions.selection import quantile_columns


def require_columns(df: DataFrame, columns: Sequence[str], strict: bool = True) -> list[str]:
    """The missing columns; raises when there are any and ``strict`` is set."""
    missing = [c for c in columns if c not in df.columns]
    if missing and strict:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if missing:
        warnings.warn(f"missing optional columns: {', '.join(missing)}", stacklevel=2)
    return missing


def column_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, present, filled)``: is the column there, and in how many rows."""
    here = [c for c in columns if c in df.columns]
    counts = df.agg(
        *[
            (F.count(c) if c in here else F.lit(None).cast("bigint")).alias(c)
            for c in columns
        ],
        F.count(F.lit(1)).alias("_rows"),
    )
    return (
        to_metrics(counts.drop("_rows"), "bigint")
        .withColumnsRenamed({"metric": "column", "value": "filled"})
        .withColumn("present", F.col("column").isin(here))
        .select("column", "present", F.coalesce("filled", F.lit(0)).alias("filled"))
    )


def write_verified(df: DataFrame, keep: Column, path: str, key: str, name: str) -> DataFrame:
    """Writes the rows that ``keep`` holds for, and reports whether they arrived; ``df`` is read once.

    The copy lies in ``accepted(path)``. Keys of the other rows are written
    next to it, so that all keys can be counted without a second look at
    ``df``. Rows and a checksum of the keys are observed on the way to the files and
    compared with what is in them; ``keys_expected`` is null if the checksums differ.
    """
    spark = df.sparkSession
    kept = F.coalesce(keep, F.lit(False))
    checksum = F.sum(F.when(F.col("_kept"), F.xxhash64(key).cast("decimal(20,0)")))
    rows = [F.count(F.lit(1)).alias("before"), F.count_if("_kept").alias("expected")]
    watch = Observation(f"write {name}")
    marked = df.withColumn("_kept", kept).observe(watch, *rows, checksum.alias("checksum"))
    slim = marked.select(
        "_kept", *[F.col(c) if c == key else F.when(F.col("_kept"), F.col(c)).alias(c) for c in df.columns]
    )
    slim.write.mode("overwrite").partitionBy("_kept").parquet(path)
    seen = watch.get
    files = spark.read.schema(slim.schema).parquet(path).select(key, "_kept")
    report = files.agg(
        F.count_if("_kept").alias("rows_written"),
        checksum.alias("_checksum"),
        F.count_distinct(key).alias("keys_before"),
        F.count_distinct(F.when(F.col("_kept"), F.col(key))).alias("keys_written"),
    )
    same = F.col("_checksum").eqNullSafe(F.lit(seen["checksum"]).cast("decimal(30,0)"))
    columns = len(spark.read.parquet(accepted(path)).columns) if seen["expected"] else len(df.columns)
    return (
        report.withColumn("table", F.lit(name))
        .withColumn("rows_before", F.lit(seen["before"]).cast("bigint"))
        .withColumn("rows_expected", F.lit(seen["expected"]).cast("bigint"))
        .withColumn("keys_expected", F.when(same, F.col("keys_written")))
        .withColumn("columns_expected", F.lit(len(df.columns)).cast("bigint"))
        .withColumn("columns_written", F.lit(columns).cast("bigint"))
        .withColumn(
            "ok",
            same & (F.col("rows_expected") == F.col("rows_written")) & (F.col("columns_expected") == F.col("columns_written")),
        )
        .drop("_checksum")
    )


def accepted(path: str) -> str:
    """Where ``write_verified`` puts the rows it keeps."""
    return f"{path.rstrip('/')}/_kept=true"


def check_detail_total(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """``(n_orders, n_lines, n_detail)``; the plan fails on empty or unequal tables.

    ``n_detail`` adds up the line counts per order and has to give the number
    of lines again.
    """
    detail = (
        lines.groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_detail"))
    )
    totals = (
        orders.agg(F.count(F.lit(1)).alias("n_orders"))
        .withColumn("n_lines", lines.agg(F.count(F.lit(1))).scalar())
        .withColumn("n_detail", detail.scalar())
    )
    guard = (
        F.when(F.col("n_orders") == 0, F.raise_error(F.lit("no orders")))
        .when(F.col("n_lines") == 0, F.raise_error(F.lit("no order lines")))
        .when(
            F.col("n_lines") != F.col("n_detail"),
            F.raise_error(F.lit("detail total does not match")),
        )
        .otherwise(F.lit(True))
    )
    return totals.withColumn("ok", guard)


def profile(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Rows, missing values, minimum, quartiles, mean and maximum per numeric column.

    Quartiles are counted on grids, in a few passes over the table. Without
    ``exact`` they are approximate and the table is read once.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    base = [
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("value").isNull().cast("bigint")).alias("n_missing"),
        F.min("value").alias("min"),
        F.avg("value").alias("mean"),
        F.max("value").alias("max"),
    ]
    names = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    if exact:
        stats = long.groupBy("column").agg(*base)
        return stats.join(quantile_columns(long, "value", names, ["column"]), "column", "left")
    stats = long.groupBy("column").agg(
        *base, F.percentile_approx("value", list(names.values()), 10000).alias("_q")
    )
    return stats.select(
        "*", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]
    ).drop("_q")

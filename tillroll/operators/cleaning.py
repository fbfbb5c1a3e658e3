"""Catalogue cleaning, line pricing and table-wide normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import (
    adjusted_rate,
    finite_or_zero,
    is_placeholder,
    money,
    paid_ratio,
    price_band,
    safe_price,
    safe_rate,
)
from tillroll.functions.ranking import row_numbers

# Raw catalogue columns that no later stage reads.
UNUSED_COLUMNS = (
    "category_url", "url", "category_tree", "image_urls", "offers", "related_products",
    "top_reviews", "other_attributes", "all_available_sizes", "main_image", "reviews_count",
)

# Price band edges and labels of the two price reports.
WIDE_EDGES = (0, 10, 20, 50, 100, 200)
WIDE_LABELS = ("$0-10", "$10-20", "$20-50", "$50-100", "$100-200", "$200+")
TENS_EDGES = tuple(range(0, 101, 10))
TENS_LABELS = (*(f"{a}-{a + 10}" for a in range(0, 100, 10)), "100+")

# Customer type written back for each customer cluster.
SEGMENT_NAMES = {1: "低价值低频客户", 2: "忠诚活跃用户", 3: "高贡献客户"}

KEY_COLUMNS = ("customer_id", "order_id", "product_id", "order_item_id")
DATE_COLUMNS = ("order_date", "registration_date")
NUMBER_COLUMNS = (
    "quantity", "unit_price", "line_total", "total_amount", "shipping_fee", "discount_rate",
    "discount_rate_adjusted", "initial_price", "final_price", "rating", "image_count", "age",
)


def drop_placeholder(df: DataFrame, column: str, token: str = "N/A") -> DataFrame:
    """Rows whose ``column`` is neither missing nor the placeholder text."""
    return df.filter(F.col(column).isNotNull() & ~is_placeholder(column, token))


def assign_key(df: DataFrame, order_by: Sequence[str], name: str = "product_id") -> DataFrame:
    """Numbers the rows 1..n in ``order_by`` order; the order must be unique."""
    return row_numbers(df, [F.col(c).asc_nulls_last() for c in order_by], name)


def with_paid_ratio(df: DataFrame, corrected: bool = False) -> DataFrame:
    return df.withColumn("discount_rate", paid_ratio("initial_price", "final_price", corrected))


def drop_unused(df: DataFrame, columns: Sequence[str] = UNUSED_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def product_lookup(products: DataFrame) -> DataFrame:
    """One priced row per usable product id.

    Of several rows with one id the smallest is kept, whatever the file order.
    """
    priced = products.select(
        F.col("product_id").try_cast("bigint").alias("product_id"),
        safe_price("final_price").alias("unit_price"),
        safe_rate("discount_rate").alias("discount_rate"),
        F.col("free_shipping").cast("boolean").alias("free_shipping"),
    ).filter(F.col("product_id") > 0)
    kept = priced.groupBy("product_id").agg(
        F.min(F.struct("unit_price", "discount_rate", "free_shipping")).alias("_first")
    )
    return kept.select("product_id", "_first.*")


def price_lines(lines: DataFrame) -> DataFrame:
    """Adds the adjusted discount and the line total in cents."""
    gross = F.col("quantity") * F.col("unit_price")
    return lines.withColumn("discount_rate_adjusted", adjusted_rate("discount_rate")).withColumn(
        "line_total",
        money(F.greatest(gross * (1 - F.col("discount_rate_adjusted")), F.lit(0.0))),
    )


def normalize_types(df: DataFrame) -> DataFrame:
    """Casts keys, dates and numbers; unreadable values become NULL.

    A missing discount rate falls back to the adjusted one.
    """
    casts: dict[str, Column] = {}
    for names, kind in ((KEY_COLUMNS, "bigint"), (DATE_COLUMNS, "date"), (NUMBER_COLUMNS, "double")):
        casts |= {c: F.col(c).try_cast(kind) for c in names if c in df.columns}
    out = df.withColumns(casts)
    if {"discount_rate", "discount_rate_adjusted"} <= set(df.columns):
        out = out.withColumn(
            "discount_rate", F.coalesce("discount_rate", "discount_rate_adjusted")
        )
    return out


def fill_unknown(df: DataFrame, columns: Sequence[str], label: str = "UNKNOWN") -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit(label)) for c in columns}
    )


def finite_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: finite_or_zero(c) for c in columns})


def complete_rows(df: DataFrame, columns: Sequence[str], fills: Mapping[str, float]) -> DataFrame:
    """Drops rows with a missing value, then replaces infinities by ``fills``."""
    kept = df.dropna(subset=list(columns))
    return kept.withColumns(
        {
            c: F.when(F.abs(F.col(c)) == float("inf"), F.lit(fills.get(c, 0))).otherwise(F.col(c))
            for c in columns
        }
    )


def price_band_report(
    df: DataFrame,
    column: str,
    edges: Sequence[float],
    labels: Sequence[str],
    right: bool,
    weight: str | None = None,
) -> DataFrame:
    """``(band, band_ord, n, pct)``; bands without rows are left out."""
    band = price_band(column, edges, labels, right)
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.groupBy(band.alias("band")).agg(n.cast("bigint").alias("n"))
    ordinal = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("band"))
    # At most one row per label, plus one for values outside, is left here.
    everything = F.sum("n").over(Window.partitionBy())
    return counted.select(
        "band",
        ordinal.cast("bigint").alias("band_ord"),
        "n",
        (F.col("n") / everything).alias("pct"),
    )


def label_segments(df: DataFrame, names: Mapping[int, str] = SEGMENT_NAMES) -> DataFrame:
    """Adds tier number and customer type of ``cluster``; unknown clusters get NULL."""
    cluster = F.col("cluster")
    name = None
    for number, label in names.items():
        name = F.when(cluster == number, label) if name is None else name.when(
            cluster == number, label
        )
    return df.withColumn("customer_hierachy", cluster.cast("int")).withColumn("customer_type", name)


def valid_price(df: DataFrame, column: str = "final_price", at_most: float | None = None):
    kept = df.filter(F.col(column) >= 0)
    return kept if at_most is None else kept.filter(F.col(column) <= at_most)


def valid_discount_pct(df: DataFrame, column: str = "discount_rate") -> DataFrame:
    """Adds ``discount_pct`` and keeps 0 to 100 percent."""
    return df.withColumn("discount_pct", F.col(column) * 100).filter(
        F.col("discount_pct").between(0, 100)
    )


def discounted(df: DataFrame, column: str = "discount_rate") -> DataFrame:
    return df.filter(F.col(column) > 0)


def valid_amount(df: DataFrame, column: str = "total_amount") -> DataFrame:
    return df.filter(F.col(column) > 0)


def period(df: DataFrame, start: str, end: str, column: str = "month") -> DataFrame:
    """Rows from ``start`` to ``end``, both included.

    On a fact stored by order month the months are named as well, so only
    their folders are listed and read.
    """
    low, high = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    kept = df.filter(F.col(column).between(low, high))
    if column == "order_date" and "order_month" in df.columns:
        kept = kept.filter(F.col("order_month").between(F.trunc(low, "MM"), high))
    return kept

"""Report tables: totals, shares, top lists, cohorts and ordinals.

Reports accept the line fact or a roll-up of it (see ``functions.grain``).
Lists are cut with a sort limit, which keeps the best rows of each partition
before merging, and every limit is tie-broken by the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import grain
from tillroll.functions.columns import comma, dollar, percent, ratio, rounded, to_metrics, total
from tillroll.functions.ranking import row_numbers
from tillroll.functions.selection import first_grid, known_values, quantile_columns, quantiles_of_grid
from tillroll.operators.features import AS_OF
from tillroll.session import pinned


def top(df: DataFrame, n: int, by: str, *keys: str) -> DataFrame:
    """The ``n`` rows with the largest ``by``; ties go to the smaller key."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys]).limit(n)


def top_with_ties(df: DataFrame, n: int, by: str) -> DataFrame:
    """All rows as large as the ``n``-th largest."""
    cut = df.select(by).orderBy(F.col(by).desc_nulls_last()).limit(n).agg(F.min(by)).scalar()
    return df.filter(F.col(by) >= cut)


def share_of(df: DataFrame, c: str, name: str) -> DataFrame:
    """Adds the share of the column total."""
    everything = df.agg(F.sum(c)).scalar()
    return df.withColumn(name, ratio(F.col(c), everything))


def ordinal(df: DataFrame, by: str, key: str, name: str, descending: bool = False) -> DataFrame:
    """Adds the 1-based place of each row, smallest first unless ``descending``."""
    value = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return row_numbers(df, [value, F.col(key).asc_nulls_last()], name)


# --- time -------------------------------------------------------------------


def month_of(c: str = "order_date") -> Column:
    return F.trunc(c, "MM")


def monthly_amount(df: DataFrame, by: Sequence[str] = (), fallback: str | None = None) -> DataFrame:
    """Sales by month from lines; lines without a total use ``fallback`` when it is given.

    Missing totals can't be told in a roll-up, so one is refused.
    """
    amount = F.coalesce("line_total", fallback) if fallback else F.col("line_total")
    return (
        _as_lines(df)
        .filter(F.col("order_date").isNotNull() & amount.isNotNull())
        .groupBy(*by, month_of().alias("month"))
        .agg(F.sum(amount).alias("amount"))
    )


def monthly_qty(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Quantity by month from lines with a quantity of at least 0; a roll-up is refused."""
    return (
        _as_lines(df)
        .filter(F.col("order_date").isNotNull() & (F.col("quantity") >= 0))
        .groupBy(*by, month_of().alias("month"))
        .agg(F.sum("quantity").alias("qty"))
    )


def _as_lines(df: DataFrame) -> DataFrame:
    if "line_count" in df.columns:
        raise ValueError("this report applies a rule to each line; pass the lines, not a roll-up")
    return df


def daily_by_segment(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("order_date").isNotNull())
        .groupBy("order_date", "customer_type")
        .agg(grain.sales(df).alias("daily_sales"), grain.order_count(df).alias("daily_orders"))
    )


# --- summary numbers --------------------------------------------------------


def price_stats(df: DataFrame) -> DataFrame:
    """Mean and median line price over non-negative prices."""
    weight = "line_count" if "line_count" in df.columns else None
    rows = known_values(df.filter(F.col("final_price") >= 0), "final_price", weight=weight)
    cells = first_grid(rows, 0, F.sum(F.col("value") * F.col("n")).alias("s"))
    middle = quantiles_of_grid(rows, cells, [0.5]).select("q")
    return cells.agg(ratio(F.sum("s"), F.sum("n")).alias("avg_price")).withColumn("median_price", middle.scalar())


def discount_stats(df: DataFrame, column: str = "discount_rate") -> DataFrame:
    """Products with a discount, all products, their ratio, mean and maximum discount."""
    has = F.col(column) > 0
    return df.agg(
        F.count_distinct(F.when(has, F.col("product_id"))).alias("discounted_product_count"),
        F.count_distinct("product_id").alias("total_product_count"),
        F.avg(F.when(has, F.col(column))).alias("avg_discount_rate"),
        F.max(column).alias("max_discount_rate"),
    ).withColumn(
        "discounted_ratio", ratio(F.col("discounted_product_count"), F.col("total_product_count"))
    )


def dimension_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_distinct("root_category").alias("root_category_count"),
        F.count_distinct("brand").alias("brand_count"),
    )


# Names of the summary metrics, in report order.
METRIC_NAMES = {
    "avg_price": "商品平均价格",
    "median_price": "商品中位数价格",
    "discounted_product_count": "有折扣商品数量",
    "discounted_ratio": "折扣商品占比",
    "avg_discount_rate": "平均折扣率",
    "max_discount_rate": "最大折扣率",
    "root_category_count": "根分类数量",
    "brand_count": "品牌数量",
}


def summary_metrics(lines: DataFrame, products: DataFrame) -> DataFrame:
    """The price, discount and dimension numbers as ``(metric, value)`` rows.

    ``lines`` gives the discounts, ``products`` is the roll-up by product.
    """
    one = price_stats(products)
    for i, part in enumerate((discount_stats(lines), dimension_counts(products))):
        one = one.withColumn(f"_{i}", part.select(F.struct(*part.columns)).scalar())
        one = one.select("*", f"_{i}.*")
    one = one.select(*[rounded(F.col(c).cast("double")).alias(n) for c, n in METRIC_NAMES.items()])
    return to_metrics(one)


def overall_summary(df: DataFrame) -> DataFrame:
    """Customers, first and last month and months covered, as text."""
    one = df.agg(
        F.count_distinct("customer_id").alias("customer_count"),
        F.min(month_of()).alias("monthly_start"),
        F.max(month_of()).alias("monthly_end"),
        F.count_distinct(month_of()).alias("months_covered"),
    )
    return to_metrics(one, "string")


# --- categories, brands, attributes -----------------------------------------


def category_sales(df: DataFrame) -> DataFrame:
    return df.groupBy("root_category").agg(
        total("quantity").alias("total_qty"),
        grain.sales(df).alias("total_sales"),
        grain.line_mean(df, "final_price").alias("avg_price"),
        grain.line_mean(df, "discount_rate").alias("avg_discount"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(grain.line_count(df).alias("count"))


def brand_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("brand").agg(
        grain.line_count(df).alias("items"),
        total("quantity").alias("total_qty"),
        grain.line_mean(df, "final_price").alias("avg_price"),
        grain.line_mean(df, "discount_rate").alias("avg_discount"),
    )


def category_reach(df: DataFrame) -> DataFrame:
    """Lines, sales and distinct customers by non-empty root category."""
    return (
        df.filter(F.col("root_category") != "")
        .groupBy("root_category")
        .agg(
            grain.line_count(df).alias("items"),
            grain.sales(df).alias("sales"),
            F.count_distinct("customer_id").alias("customers"),
        )
    )


def stock_effect(df: DataFrame) -> DataFrame:
    """Sales and orders by category and stock state, with the category's place.

    Categories are placed by their in-stock sales; those without any come last.
    """
    by_state = pinned(
        df.groupBy("root_category", "in_stock").agg(
            grain.sales(df).alias("sales"), grain.order_count(df).alias("orders")
        )
    )
    in_stock_sales = by_state.groupBy("root_category").agg(
        F.max(F.when(F.col("in_stock"), F.col("sales"))).alias("_in_stock_sales")
    )
    places = ordinal(
        in_stock_sales, "_in_stock_sales", "root_category", "category_ord", descending=True
    ).drop("_in_stock_sales")
    return by_state.join(
        places.withColumnRenamed("root_category", "_category"),
        F.col("root_category").eqNullSafe(F.col("_category")),
        "left",
    ).drop("_category")


def catalogue_by(products: DataFrame, column: str) -> DataFrame:
    """Product count, mean price and mean discount by one catalogue column."""
    return products.groupBy(column).agg(
        F.count(F.lit(1)).alias("product_count"),
        F.avg("final_price").alias("avg_price"),
        F.avg("discount_rate").alias("avg_discount"),
    )


def color_price(products: DataFrame, at_least: int = 10, n: int = 15) -> DataFrame:
    """The dearest colours among those with enough products."""
    priced = (
        products.filter(F.col("color") != "")
        .groupBy("color")
        .agg(F.count(F.lit(1)).alias("count"), F.avg("final_price").alias("avg_price"))
        .filter(F.col("count") >= at_least)
    )
    return top(priced, n, "avg_price", "color")


def category_discount(products: DataFrame) -> DataFrame:
    return (
        products.filter(F.col("discount_rate") > 0)
        .groupBy("root_category")
        .agg(F.avg("discount_rate").alias("avg_discount"))
    )


def rating_sales(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("rating").isNotNull())
        .groupBy("product_id", "rating")
        .agg(grain.sales(df).alias("sales"))
    )


def content_richness(df: DataFrame) -> DataFrame:
    """Image count, description length and sales per product."""
    text = F.col("description") if "description" in df.columns else F.lit(None).cast("string")
    length = F.length(F.coalesce(text, F.lit(""))) if "description" in df.columns else F.length(text)
    return df.groupBy("product_id").agg(
        F.max("image_count").alias("image_count"),
        F.max(length).alias("desc_len"),
        grain.sales(df).alias("sales"),
    )


def brands_per_category(df: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` best-selling brands of each category, no ties."""
    by_brand = df.groupBy("root_category", "brand").agg(grain.sales(df).alias("sales"))
    place = Window.partitionBy("root_category").orderBy(
        F.col("sales").desc(), F.col("brand").asc_nulls_last()
    )
    return by_brand.withColumn("_n", F.row_number().over(place)).filter(F.col("_n") <= n).drop("_n")


def top_and_other(
    df: DataFrame, measure: Column, n: int = 5, extra: dict[str, Column] | None = None,
    share: str | None = None,
) -> DataFrame:
    """The ``n`` largest categories, the rest added up as ``Other``, with shares.

    ``extra`` columns are added up along; ``share`` names the column the share
    is taken of, ``value`` unless given.
    """
    extra = extra or {}
    by_category = (
        df.filter(F.col("root_category").isNotNull())
        .groupBy("root_category")
        .agg(measure.alias("value"), *[c.alias(k) for k, c in extra.items()])
    )
    # The list of winners has n rows whatever the data, so it can be broadcast.
    winners = top(by_category, n, "value", "root_category").select(
        "root_category", F.lit(True).alias("_top")
    )
    lumped = (
        by_category.join(F.broadcast(winners), "root_category", "left")
        .withColumn("root_category", F.when(F.col("_top"), F.col("root_category")).otherwise("Other"))
        .groupBy("root_category")
        .agg(F.sum("value").alias("value"), *[F.sum(k).alias(k) for k in extra])
    )
    # n + 1 rows are left for the window.
    whole = F.sum(share or "value").over(Window.partitionBy())
    return lumped.withColumn("pct", ratio(F.col(share or "value"), whole))


# --- customers and orders ---------------------------------------------------


def rfm(df: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Recency, frequency and monetary value per customer, type and tier."""
    return (
        df.groupBy("customer_id", "customer_type", "customer_hierachy")
        .agg(
            grain.order_count(df).alias("order_count"),
            grain.sales(df).alias("monetary"),
            F.max("order_date").alias("last_order_date"),
            F.min("order_date").alias("first_order_date"),
        )
        .withColumn("avg_order_value", ratio(F.col("monetary"), F.col("order_count")))
        .withColumn("recency_days", F.datediff(F.to_date(F.lit(as_of)), "last_order_date"))
        .withColumn("frequency", F.col("order_count"))
    )


def segment_counts(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_type").agg(F.count(F.lit(1)).alias("n"))


def modal_names(df: DataFrame) -> DataFrame:
    """The customer type most lines of a cluster carry; ties go to the first name."""
    known = df.filter(F.col("cluster").isNotNull() & F.col("customer_type").isNotNull())
    counted = known.groupBy("cluster", "customer_type").agg(grain.line_count(df).alias("n"))
    return counted.groupBy("cluster").agg(
        F.min_by("customer_type", F.struct(-F.col("n"), F.col("customer_type"))).alias("cluster_name")
    )


def named_clusters(df: DataFrame, names: DataFrame) -> DataFrame:
    """Adds the cluster name, ``Cluster n`` where there is none."""
    fallback = F.concat(F.lit("Cluster "), F.col("cluster").cast("string"))
    return df.join(names, "cluster", "left").withColumn(
        "cluster_name", F.coalesce("cluster_name", fallback)
    )


def segment_share(summary: DataFrame, names: DataFrame) -> DataFrame:
    """Customers per cluster with name, share and label."""
    shared = named_clusters(share_of(summary, "customer_count", "pct"), names)
    label = F.concat(
        F.col("cluster").cast("string"), F.lit("\n"), comma("customer_count"), F.lit(" 人\n ("),
        percent("pct"), F.lit(")"),
    )
    return shared.select("cluster", "customer_count", "cluster_name", "pct", label.alias("label"))


def segment_sales_share(df: DataFrame, names: DataFrame) -> DataFrame:
    """Sales per cluster with name, share and label."""
    by_cluster = (
        df.filter(F.col("cluster").isNotNull()).groupBy("cluster").agg(grain.sales(df).alias("sales"))
    )
    shared = named_clusters(share_of(by_cluster, "sales", "pct_sales"), names)
    label = F.concat(
        F.col("cluster").cast("string"), F.lit("\n"), dollar("sales"), F.lit(" ("),
        percent("pct_sales"), F.lit(")"),
    )
    return shared.select("cluster", "sales", "cluster_name", "pct_sales", label.alias("label_sales"))


def purchase_days(df: DataFrame) -> DataFrame:
    """Distinct (customer, order date) with the customer's first date.

    A customer has at most one row per day here, so the window partition of
    even the busiest customer is bounded by the calendar.
    """
    days = df.filter(F.col("order_date").isNotNull()).select("customer_id", "order_date").distinct()
    first = F.min("order_date").over(Window.partitionBy("customer_id"))
    return days.withColumn("first_order", first).withColumn(
        "days_since_first", F.datediff("order_date", "first_order")
    )


def repeat_purchase_days(df: DataFrame) -> DataFrame:
    """Customers by first order date and days since then."""
    return purchase_days(df).groupBy("first_order", "days_since_first").agg(
        F.count(F.lit(1)).alias("customers")
    )


def cohort_retention(
    df: DataFrame, horizon: int | None = 90, years: Sequence[int] = (2023, 2024, 2025)
) -> DataFrame:
    """Share of each monthly cohort ordering again n days after the first order."""
    first = F.col("first_order")
    counted = (
        purchase_days(df)
        .withColumn("cohort_year", F.year(first))
        .filter(F.col("cohort_year").isin(list(years)))
        .groupBy("cohort_year", F.trunc(first, "MM").alias("cohort_month"), "days_since_first")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    # One row per cohort and day: the window is bounded by the calendar.
    biggest = F.max("customers").over(Window.partitionBy("cohort_year", "cohort_month"))
    kept = counted.withColumn("retention", ratio(F.col("customers"), biggest))
    return kept if horizon is None else kept.filter(F.col("days_since_first") <= horizon)


def channel_region(df: DataFrame, n: int = 200) -> DataFrame:
    by = df.groupBy("channel_source", "region").agg(
        grain.order_count(df).alias("orders"), grain.sales(df).alias("sales")
    )
    by = by.withColumn("avg_aov", ratio(F.col("sales"), F.col("orders")))
    return top(by, n, "sales", "channel_source", "region")


def status_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("order_status").agg(
        grain.order_count(df).alias("orders"), grain.sales(df).alias("sales")
    )


def region_sales(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(grain.sales(df).alias("sales"))


def orders_per_customer(orders: DataFrame) -> DataFrame:
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def order_frequency(orders: DataFrame) -> DataFrame:
    """How many customers placed how many orders."""
    return orders_per_customer(orders).groupBy("freq").agg(F.count(F.lit(1)).alias("customers"))


def median_order(df: DataFrame, by: str = "root_category", value: str = "final_price") -> DataFrame:
    """Groups in order of their median, as a box plot lines them up."""
    medians = quantile_columns(df, value, {"median": 0.5}, [by])
    return ordinal(medians, "median", by, "median_ord")


def top_orders(df: DataFrame, n: int = 20) -> DataFrame:
    """The largest orders with customer, date and, where known, customer type."""
    shown = [c for c in ("customer_id", "order_date", "customer_type") if c in df.columns]
    by_order = df.groupBy("order_id").agg(
        grain.sales(df).alias("order_total"), *[F.min(c).alias(c) for c in shown]
    )
    return top(by_order, n, "order_total", "order_id")


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    by_product = (
        df.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(grain.sales(df).alias("sales"))
    )
    return top(by_product, n, "sales", "product_id")

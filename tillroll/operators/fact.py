"""Joins of order lines with orders, customers and products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import money, total
from tillroll.functions.skew import LINE_ID, hot_keys, salted_left_join, with_line_id
from tillroll.operators.cleaning import label_segments
from tillroll.sources.contracts import require_columns

# Columns found on the line and on the product; the line's value goes first.
SHARED_WITH_PRODUCT = ("free_shipping", "discount_rate")


def line_hot_keys(
    lines: DataFrame, orders: DataFrame, keys: Sequence[str] = ("order_id", "product_id", "customer_id")
) -> dict[str, list]:
    """Frequent orders, products and customers of a stored line table, found in one pass.

    A customer is frequent by orders or by owning a frequent order; lines that
    carry the customer are asked themselves. Pass the result on wherever these
    lines are joined.
    """
    own = [c for c in keys if c in lines.columns]
    if "customer_id" in keys and "customer_id" not in own and "order_id" not in own:
        own.append("order_id")
    hot = hot_keys(lines, *own)
    if "customer_id" in keys and "customer_id" not in own:
        found = set(hot_keys(orders, "customer_id")["customer_id"])
        if hot.get("order_id"):
            owners = orders.filter(F.col("order_id").isin(hot["order_id"])).select("customer_id")
            found |= {r[0] for r in owners.distinct().collect() if r[0] is not None}
        hot["customer_id"] = sorted(found)
    return hot


def add_line_customer(lines: DataFrame, orders: DataFrame, hot: dict[str, list] | None = None) -> DataFrame:
    """Gives each line of a stored table the customer of its order."""
    frequent = (hot or hot_keys(lines, "order_id"))["order_id"]
    owners = orders.select("order_id", "customer_id")
    return salted_left_join(with_line_id(lines), owners, ["order_id"], frequent).drop(LINE_ID)


def combine(
    lines: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    columns: Sequence[str] | None = None,
    hot: dict[str, list] | None = None,
) -> DataFrame:
    """The denormalised fact: one row per line, order, customer and product added.

    With ``columns`` only the joins that supply one of them are made. Lines
    that carry a customer must agree with the order on it. No join carries a
    broadcast hint: Spark compares each side with its broadcast limit when it
    runs and shuffles the larger ones, where hot keys are spread out. ``lines``
    is a stored table; name ``_line`` among the columns to keep the line id
    for a further salted join. With ``hot`` from ``line_hot_keys`` no job runs
    while the plan is built.
    """
    require_columns(lines, ["order_id", "product_id"])
    require_columns(orders, ["order_id", "customer_id"])
    customer_on_line = "customer_id" in lines.columns
    wanted = set(columns) if columns else None

    def needed(table: DataFrame, keys: Sequence[str], have: Sequence[str]) -> list[str]:
        extra = [c for c in table.columns if c not in keys and c not in have]
        return extra if wanted is None else [c for c in extra if c in wanted]

    shared = [
        c
        for c in SHARED_WITH_PRODUCT
        if c in products.columns and c in lines.columns and (wanted is None or c in wanted)
    ]
    order_keys = ["order_id", "customer_id"] if customer_on_line else ["order_id"]
    from_customer = needed(customers, ["customer_id"], [*lines.columns, *orders.columns])
    from_order = needed(orders, order_keys, lines.columns)
    if not customer_on_line and from_customer and "customer_id" not in from_order:
        from_order = ["customer_id", *from_order]
    from_product = needed(
        products, ["product_id"], [*lines.columns, *orders.columns, *customers.columns]
    )

    needs = {"order_id": from_order, "customer_id": from_customer, "product_id": from_product or shared}
    if hot is None and any(needs.values()):
        hot = line_hot_keys(lines, orders, [k for k, needed_for in needs.items() if needed_for])
    fact = with_line_id(lines)
    if wanted is not None:
        keep = wanted | {"order_id", "product_id", "order_item_id", LINE_ID}
        keep |= {"customer_id"} if customer_on_line else set()
        fact = fact.select(*[c for c in fact.columns if c in keep])
    if from_order:
        fact = salted_left_join(
            fact, orders.select(*order_keys, *from_order), order_keys, hot["order_id"]
        )
    if from_customer:
        fact = salted_left_join(
            fact, customers.select("customer_id", *from_customer), ["customer_id"], hot["customer_id"]
        )
    if from_product or shared:
        renamed = products.select(
            "product_id", *from_product, *[F.col(c).alias(f"_product_{c}") for c in shared]
        )
        fact = salted_left_join(fact, renamed, ["product_id"], hot["product_id"])
        fact = fact.withColumns(
            {c: F.coalesce(F.col(c), F.col(f"_product_{c}")) for c in shared}
        ).drop(*[f"_product_{c}" for c in shared])
    return fact.select(*columns) if columns else fact.drop(LINE_ID)


def roll_up_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order totals from the lines: fee 0 with any free line, else at most the items."""
    items = lines.groupBy("order_id").agg(
        F.sum("line_total").alias("item_total"), F.bool_or("free_shipping").alias("free")
    )
    fee = F.when(F.col("free"), F.lit(0.0)).when(
        ~F.col("free") & F.col("item_total").isNotNull(),
        F.least(F.round("shipping_fee", 2), F.col("item_total")),
    )
    return (
        orders.join(items, "order_id", "left")
        .withColumn("shipping_fee", fee)
        .withColumn("total_amount", money(F.col("item_total") + F.col("shipping_fee")))
        .select("order_id", "customer_id", "order_date", "order_status", "total_amount", "shipping_fee")
    )


def order_grain(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order that has lines, with its line count, quantity and sales.

    Lines are added up before they meet the orders, so a hot order, customer
    or day costs one row per map task, and every report at order level or above
    shuffles orders instead of lines.
    """
    rolled = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        total("quantity").alias("quantity"),
        total("line_total").alias("sales"),
    )
    return rolled.join(orders, "order_id", "left")


def customer_day_grain(orders: DataFrame) -> DataFrame:
    """One row per customer and day, from the roll-up by order.

    The busiest customer has at most one row per calendar day here, so joins
    and windows by customer need no further care.
    """
    return orders.groupBy("customer_id", "order_date").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("line_count").alias("line_count"),
        F.sum("quantity").alias("quantity"),
        F.sum("sales").alias("sales"),
    )


def product_grain(lines: DataFrame, products: DataFrame) -> DataFrame:
    """One row per sold product with its line count, quantity and sales."""
    rolled = lines.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        total("quantity").alias("quantity"),
        total("line_total").alias("sales"),
    )
    return rolled.join(products, "product_id", "left")


def write_back_segments(
    fact: DataFrame, assignments: DataFrame, hot: list | None = None
) -> DataFrame:
    """Adds each customer's cluster, tier and type to the fact.

    ``hot`` names the frequent customers when they are already known, which
    spares a pass over ``fact``.
    """
    clusters = assignments.select("customer_id", "cluster").distinct()
    if hot is None:
        hot = hot_keys(fact, "customer_id")["customer_id"]
    return label_segments(
        salted_left_join(
            fact.drop("cluster", "customer_hierachy", "customer_type"),
            clusters,
            ["customer_id"],
            hot,
        )
    )


def write_back_rating(fact: DataFrame, ratings: DataFrame, hot: list | None = None) -> DataFrame:
    """Fills the rating by product, the new value before the old one."""
    new = ratings.select("product_id", F.col("rating").alias("_new_rating"))
    if hot is None:
        hot = hot_keys(fact, "product_id")["product_id"]
    joined = salted_left_join(fact, new, ["product_id"], hot)
    old = F.col("rating") if "rating" in fact.columns else F.lit(None)
    return joined.withColumn("rating", F.coalesce("_new_rating", old).cast("int")).drop("_new_rating")


def add_first_order(fact: DataFrame, hot: list | None = None) -> DataFrame:
    """Adds each customer's first order date and the days since then."""
    first = fact.groupBy("customer_id").agg(F.min("order_date").alias("first_order"))
    if hot is None:
        hot = hot_keys(fact, "customer_id")["customer_id"]
    return (
        salted_left_join(fact, first, ["customer_id"], hot)
        .filter(F.col("first_order").isNotNull())
        .withColumn("days_since_first", F.datediff("order_date", "first_order"))
    )


def in_months(df: DataFrame, months: DataFrame, column: str = "month") -> DataFrame:
    """Rows whose month is in the ``months`` table."""
    return df.join(months.select(column).distinct(), column, "left_semi")

"""Customer and product features, profiles and cluster summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import distinct_with_missing, first_known, ratio, total

# Fixed value: the day recency is counted from unless another is given.
AS_OF = "2026-08-29"

# The measures used for clustering and the profile attributes.
CUSTOMER_FEATURES = (
    "total_spend", "avg_order_value", "order_count", "recency_days", "frequency",
    "avg_discount_rate", "avg_unit_price", "unique_product_count", "category_diversity",
    "discounted_item_ratio",
)
PRODUCT_FEATURES = (
    "total_quantity", "total_revenue", "avg_line_total", "order_count", "customer_count",
    "avg_unit_price", "avg_discount_rate", "discounted_item_ratio", "recency_days",
    "frequency", "rating",
)
CUSTOMER_PROFILE = (
    "gender", "age", "region", "channel_source", "customer_type", "customer_hierachy",
    "preferred_category",
)
PRODUCT_PROFILE = (
    "product_name", "category", "root_category", "brand", "initial_price", "final_price",
    "rating", "color", "size", "in_stock", "free_shipping",
)


def orders_seen(fact: DataFrame) -> DataFrame:
    """The distinct orders behind the lines."""
    return fact.select("customer_id", "order_id", "order_date", "total_amount").distinct()


def customer_order_features(orders: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Spend, order count and dates per customer from one row per order."""
    return (
        orders.groupBy("customer_id")
        .agg(
            total("total_amount").alias("total_spend"),
            F.avg("total_amount").alias("avg_order_value"),
            distinct_with_missing("order_id").cast("bigint").alias("order_count"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
        .withColumn("recency_days", F.datediff(F.to_date(F.lit(as_of)), "last_order_date"))
    )


def _sums(measures: dict[str, Column]) -> list[Column]:
    """Sum and number of known values of each measure, which add up over any roll-up."""
    out = []
    for name, c in measures.items():
        out += [F.sum(c).alias(f"_sum_{name}"), F.count(c).alias(f"_n_{name}")]
    return out


def _mean(name: str) -> Column:
    return ratio(F.sum(f"_sum_{name}"), F.sum(f"_n_{name}"))


def _by_distinct(
    fact: DataFrame, key: str, widest: str, others: Sequence[str], measures: dict[str, Column]
) -> DataFrame:
    """Roll-ups of ``fact`` by key and each column, one below the other.

    That by ``widest`` carries the sums of the measures; a row of any of them
    has a 1 in the column that names it, so distinct values are counted by
    adding up. Each roll-up combines before its exchange, and no line is
    copied per distinct count.
    """
    one = F.lit(1).cast("bigint")
    rolled = fact.groupBy(key, widest).agg(*_sums(measures)).withColumn(f"_is_{widest}", one)
    for c in others:
        rolled = rolled.unionByName(
            fact.select(key, c).distinct().withColumn(f"_is_{c}", one), allowMissingColumns=True
        )
    return rolled


def customer_item_features(fact: DataFrame) -> DataFrame:
    """Quantities, prices, discounts and variety per customer from the lines."""
    measures = {
        "quantity": F.col("quantity"), "line_total": F.col("line_total"), "rate": F.col("discount_rate_adjusted"),
        "price": F.col("unit_price"), "discounted": (F.col("discount_rate_adjusted") > 0).cast("int"),
    }
    rolled = _by_distinct(fact, "customer_id", "product_id", ["category", "order_date"], measures)
    return rolled.groupBy("customer_id").agg(
        total("_sum_quantity").alias("total_quantity"),
        _mean("quantity").alias("avg_quantity_per_order"),
        total("_sum_line_total").alias("total_line_value"),
        _mean("rate").alias("avg_discount_rate"),
        _mean("price").alias("avg_unit_price"),
        F.sum("_is_product_id").alias("unique_product_count"),
        # Unlike the others, a missing category is none.
        F.coalesce(F.sum(F.when(F.col("category").isNotNull(), F.col("_is_category"))), F.lit(0).cast("bigint")).alias("category_diversity"),
        _mean("discounted").alias("discounted_item_ratio"),
        _mean("line_total").alias("avg_line_total"),
        F.sum("_is_order_date").alias("frequency"),
    )


def profile_of(
    fact: DataFrame, key: str, attributes: Sequence[str], order_by: str | None = None
) -> DataFrame:
    """First non-missing value of each attribute per key."""
    return fact.groupBy(key).agg(*[first_known(a, order_by).alias(a) for a in attributes])


def customer_profile(fact: DataFrame, order_by: str | None = None) -> DataFrame:
    return profile_of(fact, "customer_id", CUSTOMER_PROFILE, order_by)


def product_profile(fact: DataFrame, order_by: str | None = None) -> DataFrame:
    return profile_of(fact, "product_id", PRODUCT_PROFILE, order_by)


def product_sales_features(fact: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Sales, reach, price and activity per product."""
    measures = {
        "quantity": F.col("quantity"), "line_total": F.col("line_total"), "rate": F.col("discount_rate_adjusted"),
        "price": F.col("unit_price"), "discounted": (F.col("discount_rate_adjusted") > 0).cast("int"),
    }
    rolled = _by_distinct(fact, "product_id", "order_id", ["customer_id", "order_date"], measures)
    return (
        rolled.groupBy("product_id")
        .agg(
            total("_sum_quantity").alias("total_quantity"),
            total("_sum_line_total").alias("total_revenue"),
            _mean("line_total").alias("avg_line_total"),
            F.sum("_is_order_id").alias("order_count"),
            F.sum("_is_customer_id").alias("customer_count"),
            _mean("price").alias("avg_unit_price"),
            _mean("rate").alias("avg_discount_rate"),
            _mean("discounted").alias("discounted_item_ratio"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.sum("_is_order_date").alias("frequency"),
        )
        .withColumn("recency_days", F.datediff(F.to_date(F.lit(as_of)), "last_order_date"))
        .withColumn("active_days", F.datediff("last_order_date", "first_order_date") + 1)
    )


def join_features(*tables: DataFrame, key: str) -> DataFrame:
    """Feature tables side by side; the first one decides which keys appear."""
    out, *rest = tables
    for table in rest:
        out = out.join(table, key, "left")
    return out


def product_rating(products: DataFrame) -> DataFrame:
    """Rating 1 to 5 from quantity sold and closeness to the middle price.

    ``products`` has one row per product with ``quantity`` and ``avg_price``.
    """
    spans = products.agg(
        F.struct(
            F.min("quantity").alias("q_min"),
            (F.max("quantity") - F.min("quantity") + 1e-9).alias("q_span"),
            F.min("avg_price").alias("p_min"),
            (F.max("avg_price") - F.min("avg_price") + 1e-9).alias("p_span"),
        )
    ).scalar()
    scaled = products.withColumn("_s", spans).select(
        "product_id",
        ((F.col("quantity") - F.col("_s.q_min")) / F.col("_s.q_span")).alias("qty_scaled"),
        ((F.col("avg_price") - F.col("_s.p_min")) / F.col("_s.p_span")).alias("price_scaled"),
    )
    middle = F.lit(1.0) - F.abs(F.col("price_scaled") - 0.5) * 2
    middle = F.greatest(F.least(middle, F.lit(1.0)), F.lit(-1.0))
    score = 0.7 * F.col("qty_scaled") + 0.3 * ((middle + 1) / 2)
    # A product without a price has no score and hence no rating.
    score = F.when(
        F.col("price_scaled").isNotNull(), F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0))
    )
    stars = F.ceil(score * 5).cast("int")
    return scaled.select(
        "product_id",
        F.when(stars < 1, 1).otherwise(stars).alias("rating"),
    )


def rated_products(fact: DataFrame) -> DataFrame:
    """Input of ``product_rating`` from the line fact or the roll-up by product."""
    return fact.groupBy("product_id").agg(
        total("quantity").alias("quantity"),
        F.avg(F.coalesce("final_price", "initial_price")).alias("avg_price"),
    )


def customer_cluster_summary(features: DataFrame) -> DataFrame:
    return features.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.avg("total_spend").alias("avg_total_spend"),
        F.avg("avg_order_value").alias("avg_order_value"),
        F.avg("order_count").alias("avg_order_count"),
        F.avg("recency_days").alias("avg_recency_days"),
        F.avg("avg_discount_rate").alias("avg_discount_rate"),
        F.avg("category_diversity").alias("avg_category_diversity"),
        F.avg("discounted_item_ratio").alias("avg_discounted_item_ratio"),
    )


def product_cluster_summary(features: DataFrame) -> DataFrame:
    return features.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.avg("total_quantity").alias("avg_total_quantity"),
        F.avg("total_revenue").alias("avg_total_revenue"),
        F.avg("order_count").alias("avg_order_count"),
        F.avg("customer_count").alias("avg_customer_count"),
        F.avg("avg_unit_price").alias("avg_unit_price"),
        F.avg("avg_discount_rate").alias("avg_discount_rate"),
        F.avg("recency_days").alias("avg_recency_days"),
        F.avg("discounted_item_ratio").alias("avg_discounted_item_ratio"),
        F.avg("rating").alias("avg_rating"),
    )

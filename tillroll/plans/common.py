"""Views of the star schema that several queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import grain
from tillroll.functions.columns import rounded
from tillroll.operators.cleaning import label_segments
from tillroll.operators.fact import combine, customer_day_grain, order_grain, product_grain
from tillroll.sources.star import Star

AS_OF = "2002-01-01"
COHORT_YEARS = (1995, 1996, 1997)


def fact(star: Star, *columns: str, hot: dict[str, list] | None = None) -> DataFrame:
    """The line fact with only the joins ``columns`` need."""
    return combine(star.lines, star.orders, star.customers, star.products, columns or None, hot)


def orders_view(star: Star) -> DataFrame:
    return order_grain(star.lines, star.orders)


def products_view(star: Star) -> DataFrame:
    return product_grain(star.lines, star.products)


def rule_cluster(value: Column, low: float, high: float) -> Column:
    """Clusters by fixed thresholds, where a query must match SQL row by row."""
    return (1 + (value >= low).cast("int") + (value >= high).cast("int")).cast("bigint")


SPEND_LOW, SPEND_HIGH = 1.5e6, 2.5e6
QTY_LOW, QTY_HIGH = 650, 850


def days_view(star: Star) -> DataFrame:
    return customer_day_grain(orders_view(star))


def customer_segments(orders: DataFrame) -> DataFrame:
    """``(customer_id, cluster)`` by total sales, from an order or day roll-up."""
    spend = orders.groupBy("customer_id").agg(grain.sales(orders).alias("_spend"))
    return spend.select(
        "customer_id", rule_cluster(F.col("_spend"), SPEND_LOW, SPEND_HIGH).alias("cluster")
    )


def customers_with_segment(star: Star, orders: DataFrame) -> DataFrame:
    """Customers that ordered, with profile, cluster, tier and type."""
    profile = star.customers.drop("customer_type", "customer_hierachy")
    return label_segments(customer_segments(orders).join(profile, "customer_id", "left"))


def tagged_days(star: Star) -> DataFrame:
    """The customer-day roll-up with profile, cluster and type of the customer.

    The spend is summed over the customer's days in a window, which the
    calendar bounds, so the lines are read once.
    """
    spend = F.sum("sales").over(Window.partitionBy("customer_id"))
    days = days_view(star).withColumn("cluster", rule_cluster(spend, SPEND_LOW, SPEND_HIGH))
    profile = star.customers.drop("customer_type", "customer_hierachy")
    return label_segments(days.join(profile, "customer_id", "left"))


SEGMENT_SQL = f"""
s_spend AS (
    SELECT customer_id, sum(line_total) AS spend FROM s_order_lines GROUP BY customer_id),
s_segment AS (
    SELECT customer_id, cluster,
        CAST(cluster AS INTEGER) AS tier,
        CASE cluster WHEN 1 THEN '低价值低频客户' WHEN 2 THEN '忠诚活跃用户'
            WHEN 3 THEN '高贡献客户' END AS type_name
    FROM (SELECT customer_id, CAST(1 + CASE WHEN spend >= {SPEND_LOW} THEN 1 ELSE 0 END
            + CASE WHEN spend >= {SPEND_HIGH} THEN 1 ELSE 0 END AS BIGINT) AS cluster
          FROM s_spend)),
s_tagged AS (
    SELECT f.* EXCLUDE (customer_type, customer_hierachy), g.cluster,
        g.type_name AS customer_type, g.tier AS customer_hierachy
    FROM s_fact f LEFT JOIN s_segment g USING (customer_id))
"""


def show(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded once, at the very end."""
    return df.select(
        *[
            rounded(c, digits).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )

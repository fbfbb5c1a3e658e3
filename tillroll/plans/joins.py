"""Joins of lines, orders, customers and products."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions.columns import rounded, total
from tillroll.functions.skew import LINE_ID, hot_keys, with_line_id
from tillroll.operators import fact as facts
from tillroll.operators import features
from tillroll.plans.common import (
    SEGMENT_SQL, customer_segments, customers_with_segment, fact, orders_view, products_view, show,
)
from tillroll.operators.reports import named_clusters
from tillroll.plans.registry import q, query
from tillroll.sources.buckets import store_pair
from tillroll.sources.star import load_star


@query(
    "join_line_customer",
    "SELECT order_id, product_id, quantity, customer_id FROM s_order_lines",
)
def join_line_customer(spark, sf_dir):
    star = load_star(spark, sf_dir)
    lines = star.lines.select("order_id", "product_id", "quantity")
    return facts.add_line_customer(lines, star.orders)


@query("combined_fact", f"SELECT * REPLACE ({q('discount_rate')} AS discount_rate, {q('final_price')} AS final_price) FROM s_fact")
def combined_fact(spark, sf_dir):
    star = load_star(spark, sf_dir)
    out = facts.combine(star.lines, star.orders, star.customers, star.products)
    return out.withColumn("discount_rate", rounded("discount_rate")).withColumn(
        "final_price", rounded("final_price")
    )


@query(
    "co_partitioned_fact",
    """
    SELECT order_id, product_id, quantity, line_total, customer_id, order_date, region, gender, age, channel_source
    FROM s_fact
    """,
)
def co_partitioned_fact(spark, sf_dir):
    star = load_star(spark, sf_dir)
    profile = star.customers.select("customer_id", "region", "gender", "age", "channel_source")
    orders = star.orders.select("order_id", "customer_id", "order_date")
    owned = store_pair(orders, profile, "customer_id").joined()
    lines = star.lines.select("order_id", "product_id", "quantity", "line_total")
    return store_pair(lines, owned, "order_id").joined()


@query(
    "order_totals",
    f"""
    items AS (
        SELECT order_id, sum(line_total) AS item_total, bool_or(free_shipping) AS free
        FROM (SELECT *, {q('l_extendedprice * (1e0 - l_discount)', 2)} AS line_total,
                l_orderkey AS order_id, l_partkey % 10 = 0 AS free_shipping FROM lineitem)
        GROUP BY order_id),
    fees AS (
        SELECT o.*, item_total, CASE WHEN free THEN 0e0 WHEN item_total IS NOT NULL
            THEN least(round(shipping_fee, 2), item_total) END AS fee
        FROM s_orders o LEFT JOIN items USING (order_id))
    SELECT order_id, customer_id, order_date, order_status,
        {q('item_total + fee', 2)} AS total_amount, fee AS shipping_fee
    FROM fees
    """,
)
def order_totals(spark, sf_dir):
    star = load_star(spark, sf_dir)
    lines = star.lines.withColumn("line_total", rounded("line_total", 2))
    return facts.roll_up_orders(star.orders, lines)


@query(
    "feature_join",
    f"""
    by_order AS (
        SELECT customer_id, sum(total_amount) AS total_spend, count(DISTINCT order_id) AS order_count
        FROM (SELECT DISTINCT customer_id, order_id, order_date, total_amount FROM s_order_lines)
        GROUP BY customer_id),
    by_line AS (
        SELECT customer_id, sum(quantity) AS total_quantity,
            count(DISTINCT order_date) AS frequency
        FROM s_order_lines GROUP BY customer_id)
    SELECT customer_id, {q('total_spend', 2)} AS total_spend, order_count, total_quantity,
        frequency, gender, region
    FROM by_order LEFT JOIN by_line USING (customer_id)
    LEFT JOIN (SELECT customer_id, gender, region FROM s_customers) USING (customer_id)
    """,
)
def feature_join(spark, sf_dir):
    star = load_star(spark, sf_dir)
    orders = orders_view(star)
    by_order = features.customer_order_features(orders).select(
        "customer_id", "total_spend", "order_count"
    )
    by_line = orders.groupBy("customer_id").agg(
        total("quantity").alias("total_quantity"),
        F.count_distinct("order_date").alias("frequency"),
    )
    profile = star.customers.select("customer_id", "gender", "region")
    return show(features.join_features(by_order, by_line, profile, key="customer_id"), 2)


@query(
    "writeback_segments",
    f"""
    {SEGMENT_SQL}
    SELECT order_id, product_id, quantity, customer_id, cluster, customer_hierachy, customer_type
    FROM s_tagged
    """,
)
def writeback_segments(spark, sf_dir):
    star = load_star(spark, sf_dir)
    hot = facts.line_hot_keys(star.lines, star.orders)
    lines = fact(star, "order_id", "product_id", "quantity", "customer_id", LINE_ID, hot=hot)
    return facts.write_back_segments(
        lines, customer_segments(orders_view(star)), hot["customer_id"]
    ).drop(LINE_ID)


@query(
    "writeback_rating",
    f"""
    stats AS (
        SELECT product_id, sum(coalesce(quantity, 0)) AS qty,
            avg(coalesce(final_price, initial_price)) AS price
        FROM s_fact GROUP BY product_id),
    scaled AS (
        SELECT product_id,
            (qty - min(qty) OVER ()) / (max(qty) OVER () - min(qty) OVER () + 1e-9) AS qs,
            (price - min(price) OVER ()) / (max(price) OVER () - min(price) OVER () + 1e-9) AS ps
        FROM stats),
    rated AS (
        SELECT product_id, greatest(CAST(ceil(5 * greatest(least(0.7 * qs
            + 0.3 * ((greatest(least(1 - 2 * abs(ps - 0.5), 1), -1) + 1) / 2), 1), 0)) AS INTEGER), 1)
            AS new_rating
        FROM scaled)
    SELECT order_id, product_id, quantity,
        CASE WHEN product_id % 6 = 0 THEN 9 ELSE new_rating END AS rating
    FROM s_lines LEFT JOIN rated USING (product_id)
    """,
)
def writeback_rating(spark, sf_dir):
    star = load_star(spark, sf_dir)
    lines = star.lines.select("order_id", "product_id", "quantity", F.lit(9).alias("rating"))
    sold = features.rated_products(products_view(star))
    ratings = features.product_rating(sold).filter(F.col("product_id") % 6 != 0)
    hot = hot_keys(lines, "product_id")["product_id"]
    return facts.write_back_rating(with_line_id(lines), ratings, hot).drop(LINE_ID)


@query(
    "join_first_order",
    """
    SELECT order_id, product_id, customer_id, order_date, first_order,
        CAST(order_date - first_order AS INTEGER) AS days_since_first
    FROM s_order_lines JOIN (
        SELECT customer_id, min(order_date) AS first_order FROM s_order_lines GROUP BY customer_id)
        USING (customer_id)
    """,
)
def join_first_order(spark, sf_dir):
    star = load_star(spark, sf_dir)
    hot = facts.line_hot_keys(star.lines, star.orders)
    lines = fact(star, "order_id", "product_id", "customer_id", "order_date", LINE_ID, hot=hot)
    return facts.add_first_order(lines, hot["customer_id"]).drop(LINE_ID)


@query(
    "join_name_fallback",
    f"""
    {SEGMENT_SQL}
    SELECT cluster, count(*) AS customers,
        CASE cluster WHEN 1 THEN '低价值低频客户' WHEN 3 THEN '高贡献客户'
            ELSE 'Cluster ' || cluster END AS cluster_name
    FROM s_segment GROUP BY cluster
    """,
)
def join_name_fallback(spark, sf_dir):
    star = load_star(spark, sf_dir)
    tagged = customers_with_segment(star, orders_view(star))
    counted = tagged.groupBy("cluster").agg(F.count(F.lit(1)).alias("customers"))
    names = (
        tagged.filter(F.col("cluster") != 2)
        .select("cluster", F.col("customer_type").alias("cluster_name"))
        .distinct()
    )
    return named_clusters(counted, names)


@query(
    "semi_months",
    """
    SELECT order_id, CAST(date_trunc('month', order_date) AS DATE) AS month FROM s_orders
    WHERE date_trunc('month', order_date) IN (
        SELECT date_trunc('month', order_date) FROM s_orders GROUP BY 1
        HAVING sum(total_amount) > (
            SELECT avg(m) FROM (SELECT sum(total_amount) AS m FROM s_orders
                GROUP BY date_trunc('month', order_date))))
    """,
)
def semi_months(spark, sf_dir):
    orders = load_star(spark, sf_dir).orders
    monthly = orders.groupBy(F.trunc("order_date", "MM").alias("month")).agg(
        F.sum("total_amount").alias("amount")
    )
    strong = monthly.filter(F.col("amount") > monthly.agg(F.avg("amount")).scalar())
    dated = orders.select("order_id", F.trunc("order_date", "MM").alias("month"))
    return facts.in_months(dated, strong)

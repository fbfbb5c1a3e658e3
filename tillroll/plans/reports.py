"""Aggregates, windows, top lists and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions.columns import dollar, total
from tillroll.operators import cleaning, features, reports
from tillroll.plans.common import (
    AS_OF, COHORT_YEARS, QTY_HIGH, QTY_LOW, SEGMENT_SQL, SPEND_HIGH, SPEND_LOW, customer_segments,
    days_view, fact, orders_view, products_view, rule_cluster, show, tagged_days,
)
from tillroll.plans.registry import q, query
from tillroll.session import pinned
from tillroll.sources.star import load_star

DIMENSIONS = ("brand", "root_category", "color", "size")


def _known_products(star):
    """The product roll-up with missing dimensions named."""
    return cleaning.fill_unknown(products_view(star), DIMENSIONS)


# --- features ---------------------------------------------------------------

CUST_ORDER_SQL = f"""
    cust_order AS (
        SELECT customer_id, coalesce(sum(total_amount), 0) AS total_spend,
            avg(total_amount) AS avg_order_value, count(DISTINCT order_id) AS order_count,
            min(order_date) AS first_order_date, max(order_date) AS last_order_date,
            CAST(DATE '{AS_OF}' - max(order_date) AS INTEGER) AS recency_days
        FROM (SELECT DISTINCT customer_id, order_id, order_date, total_amount FROM s_order_lines)
        GROUP BY customer_id)"""

CUST_ITEM_SQL = """
    cust_item AS (
        SELECT customer_id, sum(quantity) AS total_quantity,
            avg(quantity) AS avg_quantity_per_order, sum(line_total) AS total_line_value,
            avg(discount_rate_adjusted) AS avg_discount_rate, avg(unit_price) AS avg_unit_price,
            count(DISTINCT product_id) AS unique_product_count,
            count(DISTINCT category) AS category_diversity,
            avg(CASE WHEN discount_rate_adjusted > 0 THEN 1e0 ELSE 0e0 END) AS discounted_item_ratio,
            avg(line_total) AS avg_line_total, count(DISTINCT order_date) AS frequency
        FROM s_fact GROUP BY customer_id)"""

PROD_SALES_SQL = f"""
    prod_sales AS (
        SELECT product_id, sum(quantity) AS total_quantity, sum(line_total) AS total_revenue,
            avg(line_total) AS avg_line_total, count(DISTINCT order_id) AS order_count,
            count(DISTINCT customer_id) AS customer_count, avg(unit_price) AS avg_unit_price,
            avg(discount_rate_adjusted) AS avg_discount_rate,
            avg(CASE WHEN discount_rate_adjusted > 0 THEN 1e0 ELSE 0e0 END) AS discounted_item_ratio,
            min(order_date) AS first_order_date, max(order_date) AS last_order_date,
            CAST(DATE '{AS_OF}' - max(order_date) AS INTEGER) AS recency_days,
            CAST(max(order_date) - min(order_date) + 1 AS INTEGER) AS active_days,
            count(DISTINCT order_date) AS frequency
        FROM s_order_lines GROUP BY product_id)"""


def customer_items(star):
    return features.customer_item_features(
        fact(star, "customer_id", "product_id", "category", "order_date", "quantity",
             "line_total", "discount_rate_adjusted", "unit_price")
    )


def product_sales(star):
    return features.product_sales_features(
        fact(star, "product_id", "order_id", "customer_id", "order_date", "quantity",
             "line_total", "discount_rate_adjusted", "unit_price"),
        AS_OF,
    )


@query(
    "cust_order_features",
    f"""{CUST_ORDER_SQL}
    SELECT * REPLACE ({q('total_spend')} AS total_spend, {q('avg_order_value')} AS avg_order_value)
    FROM cust_order""",
)
def cust_order_features(spark, sf_dir):
    return show(features.customer_order_features(orders_view(load_star(spark, sf_dir)), AS_OF))


@query(
    "cust_item_features",
    f"""{CUST_ITEM_SQL}
    SELECT customer_id, total_quantity, {q('avg_quantity_per_order')} AS avg_quantity_per_order,
        {q('total_line_value')} AS total_line_value, {q('avg_discount_rate')} AS avg_discount_rate,
        {q('avg_unit_price')} AS avg_unit_price, unique_product_count, category_diversity,
        {q('discounted_item_ratio')} AS discounted_item_ratio,
        {q('avg_line_total')} AS avg_line_total, frequency
    FROM cust_item""",
)
def cust_item_features(spark, sf_dir):
    return show(customer_items(load_star(spark, sf_dir)))


@query(
    "cust_profile",
    """
    SELECT customer_id, min(gender) AS gender, CAST(min(age) AS BIGINT) AS age,
        min(region) AS region, min(channel_source) AS channel_source,
        min(customer_type) AS customer_type, min(customer_hierachy) AS customer_hierachy,
        min(preferred_category) AS preferred_category
    FROM s_fact GROUP BY customer_id
    """,
)
def cust_profile(spark, sf_dir):
    star = load_star(spark, sf_dir)
    # The attributes sit on the customer: one row per customer meets them, not every line.
    seen = orders_view(star).select("customer_id").distinct()
    return features.customer_profile(seen.join(star.customers, "customer_id", "left"))


@query(
    "prod_sales_features",
    f"""{PROD_SALES_SQL}
    SELECT product_id, total_quantity, {q('total_revenue')} AS total_revenue,
        {q('avg_line_total')} AS avg_line_total, order_count, customer_count,
        {q('avg_unit_price')} AS avg_unit_price, {q('avg_discount_rate')} AS avg_discount_rate,
        {q('discounted_item_ratio')} AS discounted_item_ratio, first_order_date, last_order_date,
        recency_days, active_days, frequency
    FROM prod_sales""",
)
def prod_sales_features(spark, sf_dir):
    return show(product_sales(load_star(spark, sf_dir)))


@query(
    "prod_profile",
    f"""
    SELECT product_id, min(product_name) AS product_name, min(category) AS category,
        min(root_category) AS root_category, min(brand) AS brand,
        min(initial_price) AS initial_price, {q('min(final_price)')} AS final_price,
        min(rating) AS rating, min(color) AS color, min(size) AS size,
        min(in_stock) AS in_stock, min(free_shipping) AS free_shipping
    FROM s_fact GROUP BY product_id
    """,
)
def prod_profile(spark, sf_dir):
    return show(features.product_profile(products_view(load_star(spark, sf_dir))))


RATING_SQL = """
    prod_stats AS (
        SELECT product_id, sum(coalesce(quantity, 0)) AS qty,
            avg(coalesce(final_price, initial_price)) AS price
        FROM s_fact GROUP BY product_id),
    prod_scaled AS (
        SELECT product_id,
            (qty - min(qty) OVER ()) / (max(qty) OVER () - min(qty) OVER () + 1e-9) AS qs,
            (price - min(price) OVER ()) / (max(price) OVER () - min(price) OVER () + 1e-9) AS ps
        FROM prod_stats),
    prod_rated AS (
        SELECT product_id, greatest(CAST(ceil(5 * greatest(least(0.7 * qs
            + 0.3 * ((greatest(least(1 - 2 * abs(ps - 0.5), 1), -1) + 1) / 2), 1), 0)) AS INTEGER), 1)
            AS rating
        FROM prod_scaled)"""


@query("prod_rating", f"{RATING_SQL} SELECT product_id, rating FROM prod_rated")
def prod_rating(spark, sf_dir):
    return features.product_rating(features.rated_products(products_view(load_star(spark, sf_dir))))


@query(
    "cust_cluster_summary",
    f"""{CUST_ORDER_SQL}, {CUST_ITEM_SQL}, {SEGMENT_SQL}
    SELECT cluster, count(*) AS customer_count, {q('avg(total_spend)', 2)} AS avg_total_spend,
        {q('avg(avg_order_value)', 2)} AS avg_order_value,
        {q('avg(order_count)', 2)} AS avg_order_count, {q('avg(recency_days)', 2)} AS avg_recency_days,
        {q('avg(avg_discount_rate)', 2)} AS avg_discount_rate,
        {q('avg(category_diversity)', 2)} AS avg_category_diversity,
        {q('avg(discounted_item_ratio)', 2)} AS avg_discounted_item_ratio
    FROM cust_order JOIN cust_item USING (customer_id) JOIN s_segment USING (customer_id)
    GROUP BY cluster""",
)
def cust_cluster_summary(spark, sf_dir):
    star = load_star(spark, sf_dir)
    joined = features.join_features(
        features.customer_order_features(orders_view(star), AS_OF),
        customer_items(star),
        key="customer_id",
    ).withColumn("cluster", rule_cluster(F.col("total_line_value"), SPEND_LOW, SPEND_HIGH))
    return show(features.customer_cluster_summary(joined), 2)


@query(
    "prod_cluster_summary",
    f"""{PROD_SALES_SQL}, {RATING_SQL}
    SELECT CAST(1 + CASE WHEN total_quantity >= {QTY_LOW} THEN 1 ELSE 0 END
            + CASE WHEN total_quantity >= {QTY_HIGH} THEN 1 ELSE 0 END AS BIGINT) AS cluster,
        count(*) AS product_count, {q('avg(total_quantity)', 2)} AS avg_total_quantity,
        {q('avg(total_revenue)', 2)} AS avg_total_revenue,
        {q('avg(order_count)', 2)} AS avg_order_count,
        {q('avg(customer_count)', 2)} AS avg_customer_count,
        {q('avg(avg_unit_price)', 2)} AS avg_unit_price,
        {q('avg(avg_discount_rate)', 2)} AS avg_discount_rate,
        {q('avg(recency_days)', 2)} AS avg_recency_days,
        {q('avg(discounted_item_ratio)', 2)} AS avg_discounted_item_ratio,
        {q('avg(rating)', 2)} AS avg_rating
    FROM prod_sales JOIN prod_rated USING (product_id) GROUP BY 1""",
)
def prod_cluster_summary(spark, sf_dir):
    star = load_star(spark, sf_dir)
    sales = pinned(product_sales(star))
    sold = sales.join(star.products, "product_id", "left").select(
        "product_id",
        F.col("total_quantity").alias("quantity"),
        F.coalesce("final_price", "initial_price").alias("avg_price"),
    )
    joined = features.join_features(
        sales, features.product_rating(sold), key="product_id"
    ).withColumn("cluster", rule_cluster(F.col("total_quantity"), QTY_LOW, QTY_HIGH))
    return show(features.product_cluster_summary(joined), 2)


# --- months and summary numbers ----------------------------------------------


@query(
    "monthly_amount",
    f"""
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
        {q('sum(coalesce(line_total, total_amount))', 2)} AS amount
    FROM (SELECT * REPLACE (CASE WHEN product_id % 50 = 0 THEN NULL ELSE line_total END AS line_total,
        CASE WHEN product_id % 100 = 0 THEN NULL ELSE total_amount END AS total_amount)
        FROM s_order_lines)
    WHERE order_date IS NOT NULL AND coalesce(line_total, total_amount) IS NOT NULL GROUP BY 1
    """,
)
def monthly_amount(spark, sf_dir):
    star = load_star(spark, sf_dir)
    lines = fact(star, "product_id", "order_date", "line_total", "total_amount").withColumns(
        {
            "line_total": F.when(F.col("product_id") % 50 != 0, F.col("line_total")),
            "total_amount": F.when(F.col("product_id") % 100 != 0, F.col("total_amount")),
        }
    )
    return show(reports.monthly_amount(lines, fallback="total_amount"), 2)


@query(
    "monthly_qty",
    """
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, sum(quantity) AS qty
    FROM (SELECT order_date, CASE WHEN product_id % 7 = 0 THEN -quantity
            WHEN product_id % 11 = 0 THEN NULL ELSE quantity END AS quantity FROM s_order_lines)
    WHERE order_date IS NOT NULL AND quantity >= 0 GROUP BY 1
    """,
)
def monthly_qty(spark, sf_dir):
    """Some lines have a negative or no quantity, by product."""
    key, quantity = F.col("product_id"), F.col("quantity")
    changed = F.when(key % 7 == 0, -quantity).when(key % 11 != 0, quantity)
    lines = fact(load_star(spark, sf_dir), "product_id", "order_date", "quantity")
    return reports.monthly_qty(lines.withColumn("quantity", changed))


@query(
    "price_stats",
    f"""
    SELECT {q('avg(final_price)')} AS avg_price, {q('median(final_price)')} AS median_price
    FROM s_fact WHERE final_price IS NOT NULL AND final_price >= 0
    """,
)
def price_stats(spark, sf_dir):
    return show(reports.price_stats(products_view(load_star(spark, sf_dir))))


@query(
    "discount_stats",
    f"""
    SELECT count(DISTINCT CASE WHEN discount_rate_adjusted > 0.05 THEN product_id END)
            AS discounted_product_count,
        count(DISTINCT product_id) AS total_product_count,
        {q('avg(CASE WHEN discount_rate_adjusted > 0.05 THEN discount_rate_adjusted END)')}
            AS avg_discount_rate,
        max(CASE WHEN discount_rate_adjusted > 0.05 THEN discount_rate_adjusted ELSE 0e0 END)
            AS max_discount_rate,
        {q('''count(DISTINCT CASE WHEN discount_rate_adjusted > 0.05 THEN product_id END)
            / count(DISTINCT product_id)''')} AS discounted_ratio
    FROM s_lines
    """,
)
def discount_stats(spark, sf_dir):
    lines = load_star(spark, sf_dir).lines
    deep = F.when(F.col("discount_rate_adjusted") > 0.05, F.col("discount_rate_adjusted"))
    return show(
        reports.discount_stats(
            lines.select("product_id", F.coalesce(deep, F.lit(0.0)).alias("discount_rate"))
        )
    )


@query(
    "dimension_counts",
    """
    SELECT count(DISTINCT coalesce(root_category, 'UNKNOWN')) AS root_category_count,
        count(DISTINCT coalesce(brand, 'UNKNOWN')) AS brand_count
    FROM s_fact
    """,
)
def dimension_counts(spark, sf_dir):
    return reports.dimension_counts(_known_products(load_star(spark, sf_dir)))


@query(
    "summary_metrics",
    f"""
    one AS (
        SELECT avg(final_price) FILTER (final_price >= 0) AS a,
            median(final_price) FILTER (final_price >= 0) AS b,
            count(DISTINCT CASE WHEN discount_rate > 0 THEN product_id END) AS c,
            count(DISTINCT product_id) AS n,
            avg(discount_rate) FILTER (discount_rate > 0) AS d, max(discount_rate) AS e,
            count(DISTINCT root_category) AS f, count(DISTINCT brand) AS g
        FROM s_fact)
    SELECT '商品平均价格' AS metric, {q('a')} AS value FROM one
    UNION ALL SELECT '商品中位数价格', {q('b')} FROM one
    UNION ALL SELECT '有折扣商品数量', {q('c')} FROM one
    UNION ALL SELECT '折扣商品占比', {q('c / n')} FROM one
    UNION ALL SELECT '平均折扣率', {q('d')} FROM one
    UNION ALL SELECT '最大折扣率', {q('e')} FROM one
    UNION ALL SELECT '根分类数量', {q('f')} FROM one
    UNION ALL SELECT '品牌数量', {q('g')} FROM one
    """,
)
def summary_metrics(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return reports.summary_metrics(star.lines, pinned(_known_products(star)))


@query(
    "overall_summary",
    """
    one AS (
        SELECT count(DISTINCT customer_id) AS n,
            CAST(min(date_trunc('month', order_date)) AS DATE) AS lo,
            CAST(max(date_trunc('month', order_date)) AS DATE) AS hi,
            count(DISTINCT date_trunc('month', order_date)) AS m
        FROM s_order_lines)
    SELECT 'customer_count' AS metric, CAST(n AS VARCHAR) AS value FROM one
    UNION ALL SELECT 'monthly_start', CAST(lo AS VARCHAR) FROM one
    UNION ALL SELECT 'monthly_end', CAST(hi AS VARCHAR) FROM one
    UNION ALL SELECT 'months_covered', CAST(m AS VARCHAR) FROM one
    """,
)
def overall_summary(spark, sf_dir):
    return reports.overall_summary(orders_view(load_star(spark, sf_dir)))


# --- categories, brands, attributes ------------------------------------------


@query(
    "top5_categories",
    f"""
    SELECT root_category, sum(quantity) AS total_qty, {q('sum(line_total)')} AS total_sales,
        {q('avg(final_price)')} AS avg_price, {q('avg(p_rate)')} AS avg_discount
    FROM s_lines JOIN (SELECT product_id, root_category, final_price, discount_rate AS p_rate
        FROM s_products) USING (product_id)
    GROUP BY root_category ORDER BY total_qty DESC, root_category LIMIT 5
    """,
)
def top5_categories(spark, sf_dir):
    by_category = reports.category_sales(_known_products(load_star(spark, sf_dir)))
    return show(reports.top(by_category, 5, "total_qty", "root_category"))


@query(
    "value_counts",
    """
    SELECT 'color' AS dimension, color AS value, count(*) AS "count" FROM s_fact GROUP BY color
    UNION ALL SELECT 'size', size, count(*) FROM s_fact GROUP BY size
    """,
)
def value_counts(spark, sf_dir):
    products = _known_products(load_star(spark, sf_dir))
    parts = [
        reports.value_counts(products, c)
        .withColumnRenamed(c, "value")
        .withColumn("dimension", F.lit(c))
        for c in ("color", "size")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "value_counts_top20",
    """
    SELECT size, count(*) AS "count" FROM s_fact GROUP BY size
    ORDER BY "count" DESC, size LIMIT 20
    """,
)
def value_counts_top20(spark, sf_dir):
    counts = reports.value_counts(_known_products(load_star(spark, sf_dir)), "size")
    return reports.top(counts, 20, "count", "size")


@query(
    "brand_top10",
    f"""
    SELECT brand, count(*) AS items, sum(quantity) AS total_qty,
        {q('avg(final_price)')} AS avg_price, {q('avg(p_rate)')} AS avg_discount
    FROM s_lines JOIN (SELECT product_id, brand, final_price, discount_rate AS p_rate
        FROM s_products) USING (product_id)
    GROUP BY brand ORDER BY items DESC, brand LIMIT 10
    """,
)
def brand_top10(spark, sf_dir):
    by_brand = reports.brand_summary(_known_products(load_star(spark, sf_dir)))
    return show(reports.top(by_brand, 10, "items", "brand"))


@query(
    "category_top50",
    f"""
    c AS (
        SELECT root_category, count(*) AS items, sum(line_total) AS sales,
            count(DISTINCT customer_id) AS customers
        FROM s_fact WHERE root_category <> '' GROUP BY root_category)
    SELECT root_category, items, {q('sales')} AS sales, customers
    FROM (SELECT *, rank() OVER (ORDER BY items DESC) AS r FROM c) WHERE r <= 50
    """,
)
def category_top50(spark, sf_dir):
    lines = fact(load_star(spark, sf_dir), "root_category", "line_total", "customer_id")
    return show(reports.top_with_ties(reports.category_reach(lines), 50, "items"))


@query(
    "stock_effect",
    f"""
    e AS (
        SELECT root_category, in_stock, sum(line_total) AS sales, count(DISTINCT order_id) AS orders
        FROM s_fact GROUP BY ALL),
    p AS (
        SELECT root_category, row_number() OVER (
            ORDER BY max(CASE WHEN in_stock THEN sales END) DESC NULLS LAST, root_category)
            AS category_ord
        FROM e GROUP BY root_category)
    SELECT root_category, in_stock, {q('sales')} AS sales, orders, category_ord
    FROM e JOIN p USING (root_category)
    """,
)
def stock_effect(spark, sf_dir):
    lines = fact(load_star(spark, sf_dir), "root_category", "in_stock", "line_total", "order_id")
    return show(reports.stock_effect(lines))


@query(
    "root_category_analysis",
    f"""
    SELECT root_category, count(*) AS product_count, {q('avg(final_price)')} AS avg_price
    FROM s_products GROUP BY root_category
    """,
)
def root_category_analysis(spark, sf_dir):
    products = load_star(spark, sf_dir).products
    return show(reports.catalogue_by(products, "root_category").drop("avg_discount"))


def _top_count(name, column, n):
    @query(
        name,
        f"""
        SELECT {column}, count(*) AS product_count FROM s_products GROUP BY {column}
        ORDER BY product_count DESC, {column} LIMIT {n}
        """,
    )
    def run(spark, sf_dir):
        counts = reports.catalogue_by(load_star(spark, sf_dir).products, column)
        return reports.top(counts, n, "product_count", column).select(column, "product_count")

    return run


_top_count("top20_subcategories", "category", 20)
_top_count("top15_colors", "color", 15)
_top_count("top20_sizes", "size", 20)


@query(
    "top20_brands",
    f"""
    SELECT brand, count(*) AS product_count, {q('avg(final_price)')} AS avg_price,
        {q('avg(discount_rate)')} AS avg_discount
    FROM s_products GROUP BY brand ORDER BY product_count DESC, brand LIMIT 20
    """,
)
def top20_brands(spark, sf_dir):
    by_brand = reports.catalogue_by(load_star(spark, sf_dir).products, "brand")
    return show(reports.top(by_brand, 20, "product_count", "brand"))


@query(
    "color_price",
    f"""
    SELECT color, count(*) AS "count", {q('avg(final_price)')} AS avg_price FROM s_products
    WHERE color <> '' GROUP BY color HAVING count(*) >= 10
    ORDER BY avg(final_price) DESC, color LIMIT 15
    """,
)
def color_price(spark, sf_dir):
    return show(reports.color_price(load_star(spark, sf_dir).products))


@query(
    "category_discount",
    f"""
    SELECT root_category, {q('avg(discount_rate)')} AS avg_discount FROM s_products
    WHERE discount_rate > 0 GROUP BY root_category
    """,
)
def category_discount(spark, sf_dir):
    return show(reports.category_discount(load_star(spark, sf_dir).products))


@query(
    "rating_sales",
    f"""{RATING_SQL}
    SELECT product_id, rating, {q('sum(line_total)')} AS sales
    FROM s_lines JOIN prod_rated USING (product_id) GROUP BY ALL""",
)
def rating_sales(spark, sf_dir):
    sold = pinned(products_view(load_star(spark, sf_dir)).drop("rating"))
    rated = sold.join(
        features.product_rating(features.rated_products(sold)), "product_id", "left"
    )
    return show(reports.rating_sales(rated))


@query(
    "content_richness",
    f"""
    SELECT product_id, max(image_count) AS image_count,
        CAST(max(length(coalesce(description, ''))) AS INTEGER) AS desc_len,
        {q('sum(line_total)')} AS sales
    FROM s_fact GROUP BY product_id
    """,
)
def content_richness(spark, sf_dir):
    return show(reports.content_richness(products_view(load_star(spark, sf_dir))))


@query(
    "top20_brand_per_category",
    f"""
    SELECT root_category, brand, {q('sales')} AS sales FROM (
        SELECT root_category, brand, sum(line_total) AS sales, row_number() OVER (
            PARTITION BY root_category ORDER BY sum(line_total) DESC, brand) AS n
        FROM s_fact GROUP BY root_category, brand)
    WHERE n <= 20
    """,
)
def top20_brand_per_category(spark, sf_dir):
    return show(reports.brands_per_category(products_view(load_star(spark, sf_dir))))


def _other_sql(measure, value, extra="", extra_out="", share=None):
    share = share or value
    return f"""
    c AS (
        SELECT root_category, {measure} AS {value} {extra} FROM s_fact
        WHERE root_category IS NOT NULL GROUP BY root_category),
    t AS (SELECT root_category FROM c ORDER BY {value} DESC, root_category LIMIT 5),
    g AS (
        SELECT CASE WHEN root_category IN (SELECT root_category FROM t) THEN root_category
            ELSE 'Other' END AS root_category, sum({value}) AS {value} {extra_out}
        FROM c GROUP BY 1)
    SELECT * REPLACE ({q(value)} AS {value}), {q(f'{share} / sum({share}) OVER ()')} AS pct FROM g
    """


@query("top5_other_sales", _other_sql("sum(line_total)", "sales"))
def top5_other_sales(spark, sf_dir):
    products = products_view(load_star(spark, sf_dir))
    return show(
        reports.top_and_other(products, total("sales")).withColumnRenamed("value", "sales")
    )


@query("top5_other_qty", _other_sql("sum(quantity)", "qty"))
def top5_other_qty(spark, sf_dir):
    products = products_view(load_star(spark, sf_dir))
    return show(
        reports.top_and_other(products, total("quantity")).withColumnRenamed("value", "qty")
    )


@query(
    "top5_other_products",
    _other_sql(
        "sum(line_total)", "sales", ", count(DISTINCT product_id) AS product_id_count",
        ", CAST(sum(product_id_count) AS BIGINT) AS product_id_count", "product_id_count",
    ),
)
def top5_other_products(spark, sf_dir):
    products = products_view(load_star(spark, sf_dir)).filter(F.col("product_id").isNotNull())
    return show(
        reports.top_and_other(
            products, total("sales"),
            extra={"product_id_count": F.count(F.lit(1))}, share="product_id_count",
        ).withColumnRenamed("value", "sales")
    )


# --- customers, segments, cohorts --------------------------------------------

RFM_SQL = f"""
    rfm AS (
        SELECT customer_id, customer_type, customer_hierachy,
            count(DISTINCT order_id) AS order_count, sum(line_total) AS monetary,
            sum(line_total) / count(DISTINCT order_id) AS avg_order_value,
            min(order_date) AS first_order_date, max(order_date) AS last_order_date,
            CAST(DATE '{AS_OF}' - max(order_date) AS INTEGER) AS recency_days
        FROM s_tagged GROUP BY customer_id, customer_type, customer_hierachy)"""


def rfm_table(star):
    return reports.rfm(tagged_days(star), AS_OF)


@query(
    "rfm_base",
    f"""{SEGMENT_SQL}, {RFM_SQL}
    SELECT * REPLACE ({q('monetary')} AS monetary, {q('avg_order_value')} AS avg_order_value),
        order_count AS frequency FROM rfm""",
)
def rfm_base(spark, sf_dir):
    return show(rfm_table(load_star(spark, sf_dir)))


@query(
    "segment_counts",
    f"""{SEGMENT_SQL} SELECT type_name AS customer_type, count(*) AS n FROM s_segment GROUP BY 1""",
)
def segment_counts(spark, sf_dir):
    return reports.segment_counts(rfm_table(load_star(spark, sf_dir)))


@query(
    "segment_share",
    f"""{SEGMENT_SQL},
    c AS (SELECT cluster, count(*) AS customer_count, min(type_name) AS cluster_name
        FROM s_segment GROUP BY cluster),
    p AS (SELECT *, customer_count / sum(customer_count) OVER () AS pct FROM c)
    SELECT cluster, customer_count, cluster_name, {q('pct')} AS pct,
        cluster || chr(10) || format('{{:,}}', customer_count) || ' 人' || chr(10) || ' ('
            || format('{{:.1f}}', {q('pct * 100', 1)}) || '%)' AS label
    FROM p""",
)
def segment_share(spark, sf_dir):
    star = load_star(spark, sf_dir)
    tagged = tagged_days(star)
    summary = customer_segments(days_view(star)).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customer_count")
    )
    return show(reports.segment_share(summary, reports.modal_names(tagged)))


@query(
    "segment_sales_share",
    f"""{SEGMENT_SQL},
    c AS (SELECT cluster, sum(line_total) AS sales, min(customer_type) AS cluster_name
        FROM s_tagged GROUP BY cluster),
    p AS (SELECT *, sales / sum(sales) OVER () AS pct_sales FROM c)
    SELECT cluster, {q('sales')} AS sales, cluster_name, {q('pct_sales')} AS pct_sales,
        cluster || chr(10) || '$' || format('{{:,.2f}}', {q('sales', 2)}) || ' ('
            || format('{{:.1f}}', {q('pct_sales * 100', 1)}) || '%)' AS label_sales
    FROM p""",
)
def segment_sales_share(spark, sf_dir):
    tagged = tagged_days(load_star(spark, sf_dir))
    return show(reports.segment_sales_share(tagged, reports.modal_names(tagged)))


@query(
    "daily_by_segment",
    f"""{SEGMENT_SQL}
    SELECT order_date, customer_type, {q('sum(line_total)')} AS daily_sales,
        count(DISTINCT order_id) AS daily_orders
    FROM s_tagged WHERE order_date IS NOT NULL GROUP BY 1, 2""",
)
def daily_by_segment(spark, sf_dir):
    return show(reports.daily_by_segment(tagged_days(load_star(spark, sf_dir))))


FIRST_SQL = """
    f AS (SELECT customer_id, min(order_date) AS first_order FROM s_order_lines GROUP BY 1),
    d AS (
        SELECT customer_id, first_order, CAST(order_date - first_order AS INTEGER) AS days_since_first
        FROM s_order_lines JOIN f USING (customer_id))"""


@query(
    "repeat_purchase_days",
    f"""{FIRST_SQL}
    SELECT first_order, days_since_first, count(DISTINCT customer_id) AS customers
    FROM d WHERE days_since_first >= 0 GROUP BY 1, 2""",
)
def repeat_purchase_days(spark, sf_dir):
    return reports.repeat_purchase_days(orders_view(load_star(spark, sf_dir)))


@query(
    "cohort_retention",
    f"""{FIRST_SQL},
    c AS (
        SELECT year(first_order) AS y, CAST(date_trunc('month', first_order) AS DATE) AS m,
            days_since_first, count(DISTINCT customer_id) AS customers
        FROM d WHERE days_since_first >= 0 GROUP BY ALL)
    SELECT CAST(y AS INTEGER) AS cohort_year, m AS cohort_month, days_since_first, customers,
        {q('retention')} AS retention
    FROM (SELECT *, customers / max(customers) OVER (PARTITION BY y, m) AS retention FROM c)
    WHERE y IN {COHORT_YEARS} AND days_since_first <= 90""",
)
def cohort_retention(spark, sf_dir):
    orders = orders_view(load_star(spark, sf_dir))
    return show(reports.cohort_retention(orders, 90, COHORT_YEARS))


@query(
    "win_group_max_ratio",
    f"""{FIRST_SQL},
    c AS (
        SELECT CAST(date_trunc('month', first_order) AS DATE) AS cohort_month, days_since_first,
            count(DISTINCT customer_id) AS customers
        FROM d GROUP BY ALL)
    SELECT cohort_month, days_since_first,
        {q('customers / max(customers) OVER (PARTITION BY cohort_month)')} AS retention
    FROM c WHERE year(cohort_month) = 1995""",
)
def win_group_max_ratio(spark, sf_dir):
    orders = orders_view(load_star(spark, sf_dir))
    whole = reports.cohort_retention(orders, None, (1995,))
    return show(whole.select("cohort_month", "days_since_first", "retention"))


@query(
    "channel_region",
    f"""
    SELECT channel_source, region, count(DISTINCT order_id) AS orders,
        {q('sum(line_total)')} AS sales,
        {q('sum(line_total) / count(DISTINCT order_id)')} AS avg_aov
    FROM s_fact GROUP BY 1, 2 ORDER BY sum(line_total) DESC, channel_source, region LIMIT 200
    """,
)
def channel_region(spark, sf_dir):
    star = load_star(spark, sf_dir)
    profile = star.customers.select("customer_id", "channel_source", "region")
    return show(reports.channel_region(days_view(star).join(profile, "customer_id", "left")))


@query(
    "status_distribution",
    f"""
    SELECT order_status, count(DISTINCT order_id) AS orders, {q('sum(line_total)')} AS sales
    FROM s_order_lines GROUP BY order_status
    """,
)
def status_distribution(spark, sf_dir):
    return show(reports.status_distribution(orders_view(load_star(spark, sf_dir))))


@query(
    "region_sales",
    f"SELECT region, {q('sum(line_total)')} AS sales FROM s_fact GROUP BY region",
)
def region_sales(spark, sf_dir):
    star = load_star(spark, sf_dir)
    profile = star.customers.select("customer_id", "region")
    return show(reports.region_sales(days_view(star).join(profile, "customer_id", "left")))


@query(
    "order_frequency",
    """
    SELECT freq, count(*) AS customers FROM (
        SELECT customer_id, count(*) AS freq FROM s_orders WHERE customer_id IS NOT NULL GROUP BY 1)
    GROUP BY freq
    """,
)
def order_frequency(spark, sf_dir):
    return reports.order_frequency(load_star(spark, sf_dir).orders)


@query(
    "median_order",
    f"""
    SELECT root_category, {q('median(final_price)')} AS median,
        row_number() OVER (ORDER BY median(final_price), root_category) AS median_ord
    FROM s_products WHERE final_price <= 1000 GROUP BY root_category
    """,
)
def median_order(spark, sf_dir):
    products = cleaning.valid_price(load_star(spark, sf_dir).products, at_most=1000)
    return show(reports.median_order(products))


@query(
    "modal_segment_name",
    f"""{SEGMENT_SQL}
    SELECT cluster, customer_type AS cluster_name FROM (
        SELECT cluster, customer_type, row_number() OVER (
            PARTITION BY cluster ORDER BY count(*) DESC, customer_type) AS n
        FROM (SELECT CAST(customer_id % 4 AS BIGINT) AS cluster, customer_type FROM s_tagged)
        GROUP BY cluster, customer_type)
    WHERE n = 1""",
)
def modal_segment_name(spark, sf_dir):
    tagged = tagged_days(load_star(spark, sf_dir))
    return reports.modal_names(tagged.withColumn("cluster", F.col("customer_id") % 4))


# --- windows over small tables, order, sets ----------------------------------


@query(
    "win_share",
    f"""
    SELECT brand, {q('sum(line_total)')} AS sales,
        {q('sum(line_total) / sum(sum(line_total)) OVER ()', 6)} AS pct
    FROM s_fact GROUP BY brand
    """,
)
def win_share(spark, sf_dir):
    products = products_view(load_star(spark, sf_dir))
    by_brand = products.groupBy("brand").agg(total("sales").alias("sales"))
    shared = reports.share_of(by_brand, "sales", "pct")
    return shared.select(
        "brand", F.round(F.col("sales") + 1e-7, 4).alias("sales"),
        F.round(F.col("pct") + 1e-7, 6).alias("pct"),
    )


@query(
    "ordinal_by_value",
    """
    SELECT brand, count(*) AS items, row_number() OVER (ORDER BY count(*), brand) AS brand_ord
    FROM s_fact GROUP BY brand
    """,
)
def ordinal_by_value(spark, sf_dir):
    products = products_view(load_star(spark, sf_dir))
    items = products.groupBy("brand").agg(F.sum("line_count").alias("items"))
    return reports.ordinal(items, "items", "brand", "brand_ord")


@query(
    "top20_orders",
    f"""{SEGMENT_SQL}
    SELECT order_id, {q('sum(line_total)')} AS order_total, min(customer_id) AS customer_id,
        min(order_date) AS order_date, min(customer_type) AS customer_type
    FROM s_tagged GROUP BY order_id ORDER BY sum(line_total) DESC, order_id LIMIT 20""",
)
def top20_orders(spark, sf_dir):
    star = load_star(spark, sf_dir)
    orders = orders_view(star)
    best = reports.top_orders(orders)
    types = cleaning.label_segments(customer_segments(orders)).select("customer_id", "customer_type")
    return show(best.join(types, "customer_id", "left"))


@query(
    "top10_products",
    f"""
    best AS (
        SELECT product_id, sum(line_total) AS sales FROM s_lines WHERE product_id IS NOT NULL
        GROUP BY product_id ORDER BY sales DESC, product_id LIMIT 10)
    SELECT product_id, {q('sales')} AS sales,
        '$' || format('{{:,.2f}}', {q('sales', 2)}) AS label
    FROM best
    """,
)
def top10_products(spark, sf_dir):
    lines = load_star(spark, sf_dir).lines.select("product_id", "line_total")
    best = reports.top_products(lines)
    return show(best.withColumn("label", dollar("sales")))


@query(
    "time_order",
    """
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS orders
    FROM s_orders GROUP BY 1 ORDER BY 1
    """,
)
def time_order(spark, sf_dir):
    orders = load_star(spark, sf_dir).orders
    return (
        orders.groupBy(reports.month_of().alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy("month")
    )


@query(
    "distinct_rows",
    "SELECT DISTINCT customer_id, order_id, order_date, total_amount FROM s_order_lines",
)
def distinct_rows(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return features.orders_seen(fact(star, "customer_id", "order_id", "order_date", "total_amount"))


@query(
    "level_union",
    """
    SELECT root_category, bool_or(in_stock AND product_id % 3 = 0 AND root_category <> 'SMALL')
        AS has_stock
    FROM s_products GROUP BY root_category
    """,
)
def level_union(spark, sf_dir):
    products = load_star(spark, sf_dir).products.select(
        "root_category",
        (F.col("in_stock") & (F.col("product_id") % 3 == 0) & (F.col("root_category") != "SMALL")).alias("s"),
    )
    stocked = products.filter("s").select("root_category").distinct()
    rest = products.select("root_category").distinct().join(stocked, "root_category", "left_anti")
    return stocked.withColumn("has_stock", F.lit(True)).unionByName(
        rest.withColumn("has_stock", F.lit(False))
    )

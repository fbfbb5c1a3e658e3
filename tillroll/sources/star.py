"""The star-schema tables under the retail column names.

Operators only ever see the names used here: ``lines``, ``orders``,
``customers`` and ``products``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import paid_ratio

PRODUCTS = """
    p_partkey AS product_id,
    p_partkey AS model_number,
    p_name AS product_name,
    p_brand AS brand,
    p_type AS root_category,
    split_part(p_name, ' ', 2) AS category,
    split_part(p_name, ' ', 1) AS color,
    cast(p_size AS varchar(10)) AS size,
    p_retailprice AS initial_price,
    p_retailprice * (1e0 - ((p_partkey % 13) - 2) / 20e0) AS final_price,
    p_partkey % 20 <> 0 AS in_stock,
    p_partkey % 25 <> 0 AS free_returns,
    p_partkey % 10 = 0 AS free_shipping,
    p_partkey % 9 + 1 AS image_count,
    p_name AS description
"""

CUSTOMERS = """
    c_custkey AS customer_id,
    CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    18 + c_custkey % 58 AS age,
    n_name AS region,
    c_mktsegment AS channel_source,
    CASE c_custkey % 4 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'SMALL' WHEN 2 THEN 'LARGE' END
        AS preferred_category,
    c_custkey % 4 <> 0 AS is_active
"""

ORDERS = """
    o_orderkey AS order_id,
    o_custkey AS customer_id,
    cast(o_orderdate AS date) AS order_date,
    o_orderstatus AS order_status,
    o_totalprice AS total_amount,
    cast(o_orderkey % 25 AS double) AS shipping_fee
"""

LINES = """
    l_orderkey AS order_id,
    l_partkey AS product_id,
    l_quantity AS quantity,
    l_extendedprice / l_quantity AS unit_price,
    1e0 - l_discount AS discount_rate,
    l_discount AS discount_rate_adjusted,
    l_partkey % 10 = 0 AS free_shipping,
    l_extendedprice * (1e0 - l_discount) AS line_total
"""


def _columns(sql: str) -> list[str]:
    """The select list as one expression per column."""
    parts, depth, current = [], 0, ""
    for char in " ".join(sql.split()):
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += char
    return [p.strip() for p in [*parts, current]]


@dataclass(frozen=True)
class Star:
    lines: DataFrame
    orders: DataFrame
    customers: DataFrame
    products: DataFrame


def load_star(spark: SparkSession, sf_dir: str) -> Star:
    """Lazy, pruned scans of the four retail tables below ``sf_dir``."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    products = table("part").selectExpr(*_columns(PRODUCTS))
    products = products.withColumn("discount_rate", paid_ratio("initial_price", "final_price"))
    products = products.withColumn("rating", F.lit(None).cast("int"))
    customers = (
        table("customer")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .selectExpr(*_columns(CUSTOMERS))
        .withColumn("customer_type", F.lit(None).cast("string"))
        .withColumn("customer_hierachy", F.lit(None).cast("int"))
    )
    return Star(
        lines=table("lineitem").selectExpr(*_columns(LINES)),
        orders=table("orders").selectExpr(*_columns(ORDERS)),
        customers=customers,
        products=products,
    )


STAR_SQL = f"""
WITH base_products AS (SELECT {PRODUCTS} FROM part),
s_products AS (
    SELECT *,
        CASE WHEN initial_price IS NULL OR final_price IS NULL OR initial_price <= 0 THEN 0e0
             WHEN initial_price - final_price < 0 THEN 0e0
             WHEN (initial_price - final_price) / initial_price < 1
             THEN 1e0 - (initial_price - final_price) / initial_price
             ELSE initial_price - final_price END AS discount_rate,
        CAST(NULL AS INTEGER) AS rating
    FROM base_products),
s_customers AS (
    SELECT {CUSTOMERS}, CAST(NULL AS VARCHAR) AS customer_type,
        CAST(NULL AS INTEGER) AS customer_hierachy
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
s_orders AS (SELECT {ORDERS} FROM orders),
s_lines AS (SELECT {LINES} FROM lineitem),
s_order_lines AS (
    SELECT l.*, o.customer_id, o.order_date, o.order_status, o.total_amount, o.shipping_fee
    FROM s_lines l LEFT JOIN s_orders o USING (order_id)),
s_fact AS (
    SELECT l.order_id, l.product_id, l.quantity, l.unit_price, l.discount_rate_adjusted,
        l.line_total, l.customer_id, l.order_date, l.order_status, l.total_amount, l.shipping_fee,
        coalesce(l.free_shipping, p.free_shipping) AS free_shipping,
        coalesce(l.discount_rate, p.discount_rate) AS discount_rate,
        c.gender, c.age, c.region, c.channel_source, c.preferred_category, c.is_active,
        c.customer_type, c.customer_hierachy,
        p.model_number, p.product_name, p.brand, p.root_category, p.category, p.color, p.size,
        p.initial_price, p.final_price, p.in_stock, p.free_returns, p.image_count, p.description,
        p.rating
    FROM s_order_lines l
    LEFT JOIN s_customers c USING (customer_id)
    LEFT JOIN s_products p USING (product_id))
"""


def oracle(body: str) -> str:
    """``body`` behind the star's common table expressions.

    ``body`` starts with SELECT, or with further expressions as ``x AS (...)``.
    """
    body = body.strip()
    return f"{STAR_SQL}{'' if body.upper().startswith('SELECT') else ','}\n{body}"

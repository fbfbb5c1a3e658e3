"""Scans, sinks and table contracts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.reports import month_of
from tillroll.plans.common import orders_view, show
from tillroll.plans.registry import q, query
from tillroll.session import scratch_path
from tillroll.sources import contracts, files
from tillroll.sources.star import load_star

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("color", T.StringType()),
        T.StructField("initial_price", T.DoubleType()),
        T.StructField("in_stock", T.BooleanType()),
    ]
)


@query(
    "src_csv_catalog",
    """
    SELECT product_id, 'a "' || product_name || '", new' AS product_name,
        CASE product_id % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE brand END AS brand,
        CASE WHEN product_id % 11 = 0 THEN NULL ELSE color END AS color,
        CASE WHEN product_id % 5 = 0 THEN NULL ELSE initial_price END AS initial_price,
        in_stock
    FROM s_products
    """,
)
def src_csv_catalog(spark, sf_dir):
    path = scratch_path(spark, "catalog")
    key = F.col("product_id")
    raw = load_star(spark, sf_dir).products.select(
        "product_id",
        F.concat(F.lit('  a "'), "product_name", F.lit('", new ')).alias("product_name"),
        F.when(key % 7 == 0, "NA").when(key % 7 == 1, "null").otherwise(F.col("brand")).alias("brand"),
        F.when(key % 11 == 0, "").otherwise(F.concat(F.lit(" "), "color")).alias("color"),
        F.when(key % 5 == 0, "n.a.").otherwise(F.col("initial_price").cast("string")).alias(
            "initial_price"
        ),
        "in_stock",
    )
    # The file has its columns in another order than the schema.
    raw.select("in_stock", "color", *raw.columns[:3], "initial_price").write.option("header", True).option(
        "escape", '"'
    ).csv(path)
    return files.read_catalog_csv(spark, path, CATALOG_SCHEMA)


@query(
    "src_parquet",
    "SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem",
)
def src_parquet(spark, sf_dir):
    return files.read_table(
        spark,
        f"{sf_dir}/lineitem.parquet",
        ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"],
    )


@query(
    "src_csv_result",
    f"""
    SELECT *, CASE orders % 3 WHEN 0 THEN NULL WHEN 1 THEN ''
        ELSE 'a "' || orders || '" \\' || chr(10) || 'b, \\n' END AS label
    FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS orders,
            {q('sum(total_amount)', 2)} AS amount
        FROM s_orders GROUP BY 1)
    """,
)
def src_csv_result(spark, sf_dir):
    path = scratch_path(spark, "monthly")
    monthly = (
        load_star(spark, sf_dir)
        .orders.groupBy(month_of().alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("amount"))
    )
    n = F.col("orders")
    broken = F.concat(F.lit('a "'), n.cast("string"), F.lit('" \\\nb, \\n'))
    label = F.when(n % 3 == 1, "").when(n % 3 == 2, broken)
    files.write_csv(show(monthly, 2).withColumn("label", label), path)
    return files.read_result_csv(
        spark,
        path,
        T.StructType(
            [
                T.StructField("month", T.DateType()),
                T.StructField("orders", T.LongType()),
                T.StructField("amount", T.DoubleType()),
                T.StructField("label", T.StringType()),
            ]
        ),
    )


@query(
    "src_distinct_column",
    """
    SELECT DISTINCT preferred_category FROM s_customers
    WHERE preferred_category IS NOT NULL AND trim(preferred_category) <> ''
    """,
)
def src_distinct_column(spark, sf_dir):
    return files.distinct_values(load_star(spark, sf_dir).customers, "preferred_category")


@query(
    "sink_parquet",
    f"""
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month,
        count(DISTINCT order_id) AS orders, CAST(count(*) AS BIGINT) AS lines,
        {q('sum(line_total)', 2)} AS sales
    FROM s_order_lines GROUP BY 1
    """,
)
def sink_parquet(spark, sf_dir):
    path = scratch_path(spark, "orders")
    orders = orders_view(load_star(spark, sf_dir)).withColumn("order_month", month_of())
    files.write_table(orders, path, ["order_month"])
    months = files.read_table(spark, path)
    return show(
        months.groupBy("order_month").agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("line_count").alias("lines"),
            F.sum("sales").alias("sales"),
        ),
        2,
    )


@query(
    "sink_csv",
    """
    SELECT customer_id, region, preferred_category, CAST(age AS BIGINT) AS age, is_active
    FROM s_customers
    """,
)
def sink_csv(spark, sf_dir):
    path = scratch_path(spark, "customers")
    customers = load_star(spark, sf_dir).customers.select(
        "customer_id", "region", "preferred_category", "age", "is_active"
    )
    files.write_csv(customers, path)
    return files.read_result_csv(spark, path, customers.schema)


@query(
    "contract_columns",
    """
    SELECT 'customer_id' AS "column", TRUE AS present, count(customer_id) AS filled FROM s_customers
    UNION ALL SELECT 'region', TRUE, count(region) FROM s_customers
    UNION ALL SELECT 'preferred_category', TRUE, count(preferred_category) FROM s_customers
    UNION ALL SELECT 'customer_type', TRUE, count(customer_type) FROM s_customers
    UNION ALL SELECT 'loyalty_card', FALSE, CAST(0 AS BIGINT)
    """,
)
def contract_columns(spark, sf_dir):
    return contracts.column_report(
        load_star(spark, sf_dir).customers,
        ["customer_id", "region", "preferred_category", "customer_type", "loyalty_card"],
    )


@query(
    "contract_roundtrip",
    """
    SELECT 'products' AS "table", count(*) AS rows_before,
        count(DISTINCT product_id) AS keys_before,
        count(*) FILTER (product_id % 11 <> 0) AS rows_expected,
        count(DISTINCT CASE WHEN product_id % 11 <> 0 THEN product_id END) AS keys_expected,
        count(*) FILTER (product_id % 11 <> 0) AS rows_written,
        count(DISTINCT CASE WHEN product_id % 11 <> 0 THEN product_id END) AS keys_written,
        CAST(3 AS BIGINT) AS columns_expected, CAST(3 AS BIGINT) AS columns_written, TRUE AS ok
    FROM s_products
    """,
)
def contract_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "products")
    products = load_star(spark, sf_dir).products.select("product_id", "color", "final_price")
    return contracts.write_verified(products, F.col("product_id") % 11 != 0, path, "product_id", "products")


@query(
    "contract_row_total",
    """
    SELECT (SELECT count(*) FROM s_orders) AS n_orders, count(*) AS n_lines,
        count(*) AS n_detail, TRUE AS ok
    FROM s_lines
    """,
)
def contract_row_total(spark, sf_dir):
    star = load_star(spark, sf_dir)
    return contracts.check_detail_total(star.orders, star.lines)


@query(
    "profile_table",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_missing,
            {q(f'CAST(min({c}) AS DOUBLE)')} AS min, {q(f'avg({c})')} AS mean,
            {q(f'CAST(max({c}) AS DOUBLE)')} AS max,
            {q(f'quantile_cont({c}, 0.25)')} AS q1, {q(f'quantile_cont({c}, 0.5)')} AS median,
            {q(f'quantile_cont({c}, 0.75)')} AS q3
        FROM (SELECT CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
            CASE WHEN quantity > 45 THEN NULL ELSE line_total END AS line_total FROM s_lines)"""
        for c in ("quantity", "unit_price", "line_total")
    ),
)
def profile_table(spark, sf_dir):
    lines = load_star(spark, sf_dir).lines.select(
        "quantity",
        "unit_price",
        F.when(F.col("quantity") > 45, None).otherwise(F.col("line_total")).alias("line_total"),
    )
    return show(
        contracts.profile(lines, ["quantity", "unit_price", "line_total"])
    )

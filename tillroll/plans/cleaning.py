"""Projections, filters and catalogue cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.columns import rounded, safe_price, safe_rate
from tillroll.functions.palette import PALETTE
from tillroll.operators import cleaning, terms
from tillroll.operators.fact import product_grain
from tillroll.plans.common import SEGMENT_SQL, customer_segments, orders_view, show
from tillroll.plans.registry import q, query
from tillroll.sources.star import load_star

def key() -> Column:
    return F.col("product_id")


RAW_COLOR_SQL = """CASE WHEN product_id % 11 = 0 THEN ' n/a ' WHEN product_id % 13 = 0 THEN NULL
    ELSE color END"""


def _raw_color():
    return F.when(key() % 11 == 0, " n/a ").when(key() % 13 == 0, None).otherwise(F.col("color"))


@query(
    "clean_placeholder_filter",
    f"""
    raw AS (SELECT product_id, {RAW_COLOR_SQL} AS color FROM s_products)
    SELECT product_id, color FROM raw WHERE color IS NOT NULL AND upper(trim(color)) <> 'N/A'
    """,
)
def clean_placeholder_filter(spark, sf_dir):
    raw = load_star(spark, sf_dir).products.select("product_id", _raw_color().alias("color"))
    return cleaning.drop_placeholder(raw, "color")


@query(
    "clean_surrogate_key",
    f"""
    raw AS (SELECT model_number, {RAW_COLOR_SQL} AS color FROM s_products)
    SELECT model_number, color, row_number() OVER (ORDER BY model_number) AS product_id
    FROM raw WHERE color IS NOT NULL AND upper(trim(color)) <> 'N/A'
    """,
)
def clean_surrogate_key(spark, sf_dir):
    raw = load_star(spark, sf_dir).products.select("model_number", "product_id", _raw_color().alias("color"))
    kept = cleaning.drop_placeholder(raw, "color").drop("product_id")
    return cleaning.assign_key(kept, ["model_number"])


def _odd_prices(products):
    """Prices with missing, zero and non-positive values at fixed keys."""
    return products.select(
        "product_id",
        F.when(key() % 17 == 0, None).when(key() % 19 == 0, 0.0).otherwise(F.col("initial_price")).alias(
            "initial_price"
        ),
        F.when(key() % 23 == 0, 0.0).when(key() % 29 == 0, None).otherwise(F.col("final_price")).alias(
            "final_price"
        ),
    )


ODD_PRICES_SQL = """
odd AS (
    SELECT product_id,
        CASE WHEN product_id % 17 = 0 THEN NULL WHEN product_id % 19 = 0 THEN 0e0
            ELSE initial_price END AS initial_price,
        CASE WHEN product_id % 23 = 0 THEN 0e0 WHEN product_id % 29 = 0 THEN NULL
            ELSE final_price END AS final_price
    FROM s_products)"""


@query(
    "clean_paid_ratio",
    f"""
    {ODD_PRICES_SQL}
    SELECT product_id, initial_price, {q('final_price')} AS final_price,
        {q('''CASE WHEN initial_price IS NULL OR final_price IS NULL OR initial_price <= 0 THEN 0e0
            WHEN initial_price < final_price THEN 0e0
            WHEN (initial_price - final_price) / initial_price < 1
            THEN final_price / initial_price ELSE initial_price - final_price END''')}
            AS discount_rate
    FROM odd
    """,
)
def clean_paid_ratio(spark, sf_dir):
    odd = _odd_prices(load_star(spark, sf_dir).products)
    return cleaning.with_paid_ratio(odd).select(
        "product_id",
        "initial_price",
        rounded("final_price").alias("final_price"),
        rounded("discount_rate").alias("discount_rate"),
    )


@query("clean_drop_columns", "SELECT product_id, product_name, brand, size FROM s_products")
def clean_drop_columns(spark, sf_dir):
    products = load_star(spark, sf_dir).products
    raw = products.select(
        "product_id", "product_name", "brand", "size",
        F.concat(F.lit("item/"), "product_id").alias("url"),
        F.concat(F.lit("list/"), "category").alias("category_url"),
        F.concat(F.lit("pic/"), "product_id").alias("main_image"),
        F.lit(0).alias("reviews_count"),
    )
    return cleaning.drop_unused(raw)


COLOR_TEXT_SQL = """CASE WHEN product_id % 13 = 0 THEN NULL WHEN product_id % 11 = 0 THEN '   '
    WHEN product_id % 7 = 0 THEN 'Dark  ' || color WHEN product_id % 5 = 0 THEN upper(color)
    WHEN product_id % 3 = 0 THEN color || ' ' || category ELSE color END"""


def _color_text():
    return (
        F.when(key() % 13 == 0, None)
        .when(key() % 11 == 0, "   ")
        .when(key() % 7 == 0, F.concat(F.lit("Dark  "), "color"))
        .when(key() % 5 == 0, F.upper("color"))
        .when(key() % 3 == 0, F.concat_ws(" ", "color", "category"))
        .otherwise(F.col("color"))
    )


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_PALETTE_SQL = ", ".join(
    f"({i}, {_sql_text(group)}, {_sql_text(term.lower())})"
    for i, (group, term) in enumerate((g, t) for g, terms_ in PALETTE for t in terms_)
)


@query(
    "clean_color_group",
    f"""
    palette(ord, name, term) AS (VALUES {_PALETTE_SQL}),
    raw AS (SELECT product_id, {COLOR_TEXT_SQL} AS color FROM s_products),
    texts AS (
        SELECT DISTINCT color, regexp_replace(lower(trim(color)), '\\s+', ' ', 'g') AS t FROM raw
        WHERE trim(color) <> ''),
    stretches AS (
        SELECT ord, name, term, substring(term, CAST(a.i AS BIGINT), CAST(n.i AS BIGINT)) AS part
        FROM palette, range(1, 60) a(i), range(1, 60) n(i)
        WHERE a.i + n.i - 1 <= length(term)),
    near AS (
        SELECT t, min(CASE WHEN name = 'default' THEN -1 ELSE ord END) AS first_ord
        FROM texts, stretches
        WHERE levenshtein(part, t) <= ceil(length(t) * 0.1) GROUP BY t),
    exact AS (SELECT t, min(ord) AS first_ord FROM texts JOIN palette ON t = term GROUP BY t),
    inside AS (
        SELECT t, min(ord) AS first_ord FROM texts JOIN palette ON contains(t, term) GROUP BY t),
    grouped AS (
        SELECT DISTINCT x.t, coalesce(pe.name, pi.name,
            CASE WHEN n.first_ord = -1 THEN 'default' ELSE pn.name END,
            array_to_string(list_transform(string_split(x.t, ' '),
                lambda w: upper(w[1]) || w[2:]), ' ')) AS color_group
        FROM texts x
        LEFT JOIN exact e ON e.t = x.t LEFT JOIN palette pe ON pe.ord = e.first_ord
        LEFT JOIN inside i ON i.t = x.t LEFT JOIN palette pi ON pi.ord = i.first_ord
        LEFT JOIN near n ON n.t = x.t LEFT JOIN palette pn ON pn.ord = n.first_ord)
    SELECT product_id, raw.color, color_group FROM raw
    LEFT JOIN texts ON texts.color = raw.color
    LEFT JOIN grouped ON grouped.t = texts.t
    """,
)
def clean_color_group(spark, sf_dir):
    raw = load_star(spark, sf_dir).products.select("product_id", _color_text().alias("color"))
    return terms.classify_terms(raw, "color")


@query(
    "clean_safe_price",
    f"""
    SELECT product_id,
        greatest(coalesce(CASE WHEN product_id % 7 = 0 THEN NULL WHEN product_id % 11 = 0 THEN -5e0
            ELSE initial_price END, 0e0), 0.01e0) AS unit_price,
        {q('''least(greatest(coalesce(CASE WHEN product_id % 5 = 0 THEN NULL
            ELSE discount_rate * 2 - 0.5e0 END, 0e0), 0e0), 0.9e0)''')} AS rate
    FROM s_products
    """,
)
def clean_safe_price(spark, sf_dir):
    raw = load_star(spark, sf_dir).products.select(
        "product_id",
        F.when(key() % 7 == 0, "ask").when(key() % 11 == 0, "-5").otherwise(
            F.col("initial_price").cast("string")
        ).alias("price"),
        F.when(key() % 5 == 0, "n/a").otherwise(
            (F.col("discount_rate") * 2 - 0.5).cast("string")
        ).alias("rate"),
    )
    return raw.select(
        "product_id",
        safe_price("price").alias("unit_price"),
        rounded(safe_rate("rate")).alias("rate"),
    )


@query(
    "product_lookup",
    f"""
    SELECT product_id, {q('greatest(final_price, 0.01e0)')} AS unit_price,
        {q('least(greatest(discount_rate, 0e0), 0.9e0)')} AS discount_rate, free_shipping
    FROM s_products WHERE product_id > 0
    """,
)
def product_lookup(spark, sf_dir):
    products = load_star(spark, sf_dir).products
    return show(cleaning.product_lookup(products.unionByName(products)))


@query(
    "line_totals",
    f"""
    SELECT order_id, product_id, quantity, {q('discount_rate_adjusted')} AS discount_rate_adjusted,
        {q('greatest(quantity * unit_price * (1 - (1 - discount_rate)), 0)', 2)} AS line_total
    FROM s_lines
    """,
)
def line_totals(spark, sf_dir):
    lines = load_star(spark, sf_dir).lines.drop("discount_rate_adjusted", "line_total")
    return cleaning.price_lines(lines).select(
        "order_id", "product_id", "quantity",
        rounded("discount_rate_adjusted").alias("discount_rate_adjusted"), "line_total",
    )


@query(
    "normalize_types",
    f"""
    SELECT product_id, order_id,
        CASE WHEN product_id % 9 = 0 THEN NULL ELSE quantity END AS quantity,
        {q('CASE WHEN product_id % 4 = 0 THEN discount_rate_adjusted ELSE discount_rate END')}
            AS discount_rate,
        {q('discount_rate_adjusted')} AS discount_rate_adjusted
    FROM s_lines
    """,
)
def normalize_types(spark, sf_dir):
    raw = load_star(spark, sf_dir).lines.select(
        key().cast("string").alias("product_id"),
        F.col("order_id").cast("string").alias("order_id"),
        F.when(key() % 9 == 0, "two").otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.when(key() % 4 == 0, "").otherwise(F.col("discount_rate").cast("string")).alias(
            "discount_rate"
        ),
        F.col("discount_rate_adjusted").cast("string").alias("discount_rate_adjusted"),
    )
    return show(cleaning.normalize_types(raw))


@query(
    "fill_unknown",
    """
    SELECT product_id, CASE WHEN product_id % 3 = 0 THEN 'UNKNOWN' ELSE brand END AS brand,
        CASE WHEN product_id % 4 = 0 THEN 'UNKNOWN' ELSE size END AS size
    FROM s_products
    """,
)
def fill_unknown(spark, sf_dir):
    raw = load_star(spark, sf_dir).products.select(
        "product_id",
        F.when(key() % 3 != 0, F.col("brand")).alias("brand"),
        F.when(key() % 4 != 0, F.col("size")).alias("size"),
    )
    return cleaning.fill_unknown(raw, ["brand", "size"])


@query(
    "finite_features",
    """
    SELECT product_id, CASE WHEN product_id % 5 < 4 THEN 0e0 ELSE initial_price END AS measure
    FROM s_products
    """,
)
def finite_features(spark, sf_dir):
    raw = load_star(spark, sf_dir).products.select(
        "product_id",
        F.when(key() % 5 == 0, None)
        .when(key() % 5 == 1, float("nan"))
        .when(key() % 5 == 2, float("inf"))
        .when(key() % 5 == 3, float("-inf"))
        .otherwise(F.col("initial_price"))
        .alias("measure"),
    )
    return cleaning.finite_features(raw, ["measure"])


def _band_sql(edges, labels, right):
    cases = ""
    for i, label in enumerate(labels):
        low = f"final_price {'>' if right else '>='} {edges[i]}"
        high = f" AND final_price {'<=' if right else '<'} {edges[i + 1]}" if i + 1 < len(edges) else ""
        cases += f" WHEN {low}{high} THEN {i + 1}"
    names = ", ".join(_sql_text(x) for x in labels)
    return f"CASE{cases} END AS band_ord, [{names}] AS names"


@query(
    "price_bands",
    f"""
    wide AS (SELECT {_band_sql(cleaning.WIDE_EDGES, cleaning.WIDE_LABELS, True)} FROM s_products),
    tens AS (
        SELECT {_band_sql(cleaning.TENS_EDGES, cleaning.TENS_LABELS, False)}
        FROM s_lines JOIN s_products USING (product_id) WHERE final_price >= 0),
    counted AS (
        SELECT 'products' AS report, band_ord, names[band_ord] AS band, count(*) AS n
        FROM wide GROUP BY ALL
        UNION ALL
        SELECT 'lines', band_ord, names[band_ord], count(*) FROM tens GROUP BY ALL)
    SELECT report, band, CAST(band_ord AS BIGINT) AS band_ord, n,
        {q('n / sum(n) OVER (PARTITION BY report)')} AS pct
    FROM counted
    """,
)
def price_bands(spark, sf_dir):
    star = load_star(spark, sf_dir)
    wide = cleaning.price_band_report(
        star.products, "final_price", cleaning.WIDE_EDGES, cleaning.WIDE_LABELS, right=True
    )
    sold = cleaning.valid_price(product_grain(star.lines, star.products))
    tens = cleaning.price_band_report(
        sold, "final_price", cleaning.TENS_EDGES, cleaning.TENS_LABELS, right=False,
        weight="line_count",
    )
    return show(
        wide.withColumn("report", F.lit("products")).unionByName(
            tens.withColumn("report", F.lit("lines"))
        )
    )


@query(
    "segment_labels",
    f"""
    {SEGMENT_SQL}
    SELECT customer_id, cluster, tier AS customer_hierachy, type_name AS customer_type
    FROM s_segment
    """,
)
def segment_labels(spark, sf_dir):
    return cleaning.label_segments(customer_segments(orders_view(load_star(spark, sf_dir))))


@query(
    "filter_valid_price",
    f"""
    SELECT product_id, {q('final_price')} AS final_price, {q('discount_rate * 100')} AS discount_pct
    FROM s_products
    WHERE final_price >= 0 AND final_price <= 1000 AND discount_rate > 0
        AND discount_rate * 100 BETWEEN 0 AND 100
    """,
)
def filter_valid_price(spark, sf_dir):
    products = load_star(spark, sf_dir).products.select("product_id", "final_price", "discount_rate")
    kept = cleaning.discounted(cleaning.valid_price(products, at_most=1000))
    return show(cleaning.valid_discount_pct(kept).drop("discount_rate"))


@query(
    "filter_valid_amount",
    """
    SELECT order_id, total_amount FROM s_orders WHERE total_amount IS NOT NULL AND total_amount > 0
    """,
)
def filter_valid_amount(spark, sf_dir):
    return cleaning.valid_amount(load_star(spark, sf_dir).orders.select("order_id", "total_amount"))


@query(
    "filter_period",
    """
    SELECT order_id, order_date FROM s_orders
    WHERE order_date BETWEEN DATE '1996-05-01' AND DATE '1996-08-01'
    """,
)
def filter_period(spark, sf_dir):
    orders = load_star(spark, sf_dir).orders.select("order_id", "order_date")
    return cleaning.period(orders, "1996-05-01", "1996-08-01", "order_date")

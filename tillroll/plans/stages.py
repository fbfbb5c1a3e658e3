"""The whole chain from raw tables to reports, one function per stage.

Every stage reads and writes tables below one base folder, so a later stage
scans a narrow stored table and a lost executor never sends the work back to
the raw lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import total
from tillroll.functions.skew import LINE_ID, hot_keys, salted_left_join, with_line_id
from tillroll.operators import cleaning, distribution, fact, features, reports, segment, terms
from tillroll.operators import forecast as fc
from tillroll.operators import series as ts
from tillroll.sources.contracts import require_columns
from tillroll.sources.files import read_table, write_csv, write_table

FACT_COLUMNS = (
    "customer_id", "order_id", "order_date", "total_amount", "shipping_fee", "quantity",
    "unit_price", "line_total", "discount_rate_adjusted", "discount_rate", "free_shipping",
    "product_id", "region", "gender", "age", "channel_source", "customer_type",
    "customer_hierachy", "preferred_category", "category",
)


@dataclass(frozen=True)
class Store:
    """Stage tables by name below one folder all executors share."""

    spark: SparkSession
    base: str

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def read(self, name: str, *columns: str) -> DataFrame:
        return read_table(self.spark, self.path(name), columns or None)

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        write_table(df, self.path(name), partition_by)
        return self.read(name)

    def result(self, df: DataFrame, name: str) -> None:
        """A small result table, as Parquet and as CSV."""
        write_csv(self.write(df, name), self.path(f"{name}.csv"))


def clean_catalog(store: Store, raw: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Products: placeholder rows gone, renumbered, with paid ratio and colour group."""
    kept = cleaning.drop_placeholder(raw, "color").drop("product_id", "model_number")
    numbered = cleaning.assign_key(kept, order_by).withColumn("model_number", F.col("product_id"))
    priced = cleaning.with_paid_ratio(cleaning.drop_unused(numbered))
    return store.write(terms.classify_terms(priced, "color"), "products")


def price_orders(store: Store, lines: DataFrame, orders: DataFrame) -> None:
    """Order lines with price, discount and customer, and order totals from them."""
    lookup = cleaning.product_lookup(store.read("products"))
    bare = lines.drop("unit_price", "discount_rate", "free_shipping")
    hot = hot_keys(bare, "product_id")["product_id"]
    joined = salted_left_join(with_line_id(bare), lookup, ["product_id"], hot).drop(LINE_ID)
    priced = store.write(cleaning.price_lines(joined), "priced_lines")
    items = store.write(fact.add_line_customer(priced, orders), "order_items")
    store.write(fact.roll_up_orders(orders, items), "orders")


def build_fact(store: Store) -> DataFrame:
    """The denormalised line fact, one folder per order month."""
    joined = fact.combine(
        store.read("order_items"), store.read("orders"), store.read("customers"), store.read("products")
    )
    dated = joined.withColumn("order_month", reports.month_of())
    return store.write(dated, "fact", ["order_month"])


def _diagnose(
    store: Store, found: DataFrame, base: DataFrame, columns: Sequence[str], key: str, name: str, k_max: int
) -> None:
    """Cost and silhouette by k, components, centres and silhouette widths of one segmentation."""
    z = [c for c in found.columns if c.startswith("z_")]
    scaled = segment.scaled_features(base, columns)[0].persist()
    try:
        store.result(segment.wss_by_k(scaled, k_max), f"{name}_cost_by_k")
        store.result(segment.silhouette_by_k(scaled, k_max), f"{name}_silhouette_by_k")
        components = segment.principal_components(scaled, [key])
        store.write(components.join(found.select(key, "cluster"), key), f"{name}_components")
    finally:
        scaled.unpersist()
    store.result(segment.cluster_centers(found, z), f"{name}_cluster_centers")
    widths = store.write(segment.silhouette_detail(found, z, key), f"{name}_silhouette")
    store.result(segment.silhouette_summary(widths), f"{name}_silhouette_summary")


def segment_customers(store: Store, k: int = 3, restarts: int = 25, k_max: int = 10) -> None:
    """Customer features with cluster, the cluster table and the diagnostics."""
    lines = store.read("fact")
    require_columns(lines, FACT_COLUMNS)
    joined = features.join_features(
        features.customer_order_features(features.orders_seen(lines)),
        features.customer_item_features(lines),
        features.customer_profile(lines, "order_item_id" if "order_item_id" in lines.columns else None),
        key="customer_id",
    )
    base = store.write(joined, "customer_features_base")
    found = segment.segment(base, features.CUSTOMER_FEATURES, k, "total_spend", restarts)
    found = store.write(found, "customer_features")
    store.result(features.customer_cluster_summary(found), "customer_cluster_result")
    _diagnose(store, found, base, features.CUSTOMER_FEATURES, "customer_id", "customer", k_max)


def write_back(store: Store) -> DataFrame:
    """The fact with segment labels and product ratings."""
    lines = store.read("fact")
    hot = hot_keys(lines, "customer_id", "product_id")
    lines = with_line_id(lines)
    tagged = fact.write_back_segments(
        lines, store.read("customer_features", "customer_id", "cluster"), hot["customer_id"]
    )
    ratings = features.product_rating(store.write(features.rated_products(lines), "rated_products"))
    rated = fact.write_back_rating(tagged, ratings, hot["product_id"]).drop(LINE_ID)
    return store.write(rated, "fact_with_clusters", ["order_month"])


def segment_products(store: Store, k: int = 2, restarts: int = 25, k_max: int = 10) -> None:
    """Product features with cluster, the cluster table and the diagnostics."""
    lines = store.read("fact")
    require_columns(lines, ["in_stock", "color", "size", "brand", "rating"], strict=False)
    joined = features.join_features(
        features.product_sales_features(lines),
        features.product_profile(lines, "order_item_id" if "order_item_id" in lines.columns else None),
        key="product_id",
    )
    base = store.write(joined, "product_features_base")
    found = segment.segment(base, features.PRODUCT_FEATURES, k, "total_revenue", restarts)
    found = store.write(found, "product_features")
    store.result(features.product_cluster_summary(found), "product_cluster_result")
    _diagnose(store, found, base, features.PRODUCT_FEATURES, "product_id", "product", k_max)


def forecast_monthly(
    store: Store,
    measure: str,
    by: Sequence[str] = (),
    rules: Sequence[ts.CalendarRule] = ts.CALENDAR,
    boosted: bool = True,
    before: str | None = None,
    h: int = 6,
) -> None:
    """Series, scores of all models, test forecasts and the best model's future.

    ``measure`` is ``amount`` or ``qty``. ``by`` names the fact columns whose
    values form one series each; without any there is a single series. Months
    from ``before`` on, such as an unfinished last one, are left out.
    """
    lines = store.read("fact")
    if before:
        end = F.to_date(F.lit(before))
        lines = lines.filter((F.col("order_date") < end) & (F.col("order_month") <= F.trunc(end, "MM")))
    monthly = (
        reports.monthly_amount(lines, by, "total_amount") if measure == "amount" else reports.monthly_qty(lines, by)
    )
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by]) if by else F.lit("all")
    raw = monthly.select(key.alias("series_key"), "month", F.col(measure).alias("y"))
    adjusted = ts.apply_calendar(ts.complete_months(raw), rules)
    series = store.write(adjusted, f"monthly_{measure}")
    parted = ts.split(series.select("series_key", "month", "y"))
    learn, hold = ts.part(parted, "train"), ts.part(parted, "test")

    # Series too short to score are named instead of silently left out.
    short = ts.part(parted, "short").groupBy("series_key").agg(F.count(F.lit(1)).alias("months"))
    store.result(short, f"short_series_{measure}")

    names = ("series_key", "model", "month", "yhat")
    found = fc.forecast(learn, fc.STATISTICAL, h).select(*names)
    boosters = fc.BOOSTED if boosted else {}
    for name, (depth, leaf) in boosters.items():
        found = found.unionByName(fc.forecast_boosted(parted, name, depth, leaf, h=h).select(*names))
    found = store.write(found, f"forecasts_{measure}")
    scores = store.write(fc.accuracy(found, hold, learn), f"model_comparison_{measure}")
    store.result(scores.orderBy("series_key", "rmse", "model"), f"model_ranking_{measure}")
    store.result(fc.compare(found, hold), f"forecast_compare_{measure}")
    history = series.select("series_key", "month", "y")
    best = store.write(fc.best_model(scores), f"best_model_{measure}")
    ahead = fc.future(history, best, fc.STATISTICAL, h)
    for name in boosters:
        if best.filter(F.col("model") == name).take(1):
            scored = history.join(best.select("series_key"), "series_key", "left_semi")
            ahead = ahead.unionByName(fc.future_boosted(scored, best, name, h))
    store.result(ahead, f"future_{measure}")
    store.result(fc.intervals(learn, fc.STATISTICAL, h), f"intervals_{measure}")
    store.result(ts.local_trend(history, degree=2), f"local_trend_{measure}")
    store.result(ts.decompose(history), f"decomposition_{measure}")
    correlations = ts.acf(history).join(ts.pacf(history), ["series_key", "lag"])
    store.result(correlations, f"autocorrelation_{measure}")


def report(store: Store, as_of: str = features.AS_OF, years: Sequence[int] = (2023, 2024, 2025)) -> None:
    """The exploratory tables, read from two roll-ups of the tagged fact."""
    lines = store.read("fact_with_clusters")
    dimensions = ("brand", "root_category", "color", "size")
    products = store.write(
        cleaning.fill_unknown(lines, dimensions)
        .groupBy("product_id", *dimensions, "in_stock", "final_price", "initial_price", "discount_rate",
                 "rating", "image_count", "description")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            total("quantity").alias("quantity"),
            total("line_total").alias("sales"),
        ),
        "product_roll_up",
    )
    days = store.write(
        lines.groupBy("customer_id", "order_date", "customer_type", "customer_hierachy", "cluster",
                      "region", "channel_source")
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            F.count(F.lit(1)).alias("line_count"),
            total("quantity").alias("quantity"),
            total("line_total").alias("sales"),
        ),
        "customer_day_roll_up",
    )
    rfm = store.write(reports.rfm(days, as_of), "rfm")
    names = reports.modal_names(days)
    catalogue = store.read("products")
    spread = rfm.filter(F.col("customer_type").isNotNull()).withColumn("log_aov", F.log10("avg_order_value"))
    tables = {
        "root_category_analysis": reports.catalogue_by(catalogue, "root_category"),
        **{
            name: reports.top(reports.catalogue_by(catalogue, column), n, "product_count", column)
            for name, column, n in (
                ("top20_subcategories", "category", 20), ("top15_colors", "color", 15),
                ("top20_sizes", "size", 20), ("top20_brands", "brand", 20),
            )
        },
        "color_price": reports.color_price(catalogue),
        "category_discount": reports.category_discount(catalogue),
        "median_order": reports.median_order(cleaning.valid_price(catalogue, at_most=1000)),
        "price_density": distribution.density(cleaning.valid_price(products), "final_price", weight="line_count"),
        "discount_trend": distribution.linear_trend(
            cleaning.discounted(catalogue), "initial_price", "discount_rate"
        ),
        "rating_trend": distribution.linear_trend(reports.rating_sales(products), "rating", "sales"),
        "images_trend": distribution.linear_trend(reports.content_richness(products), "image_count", "sales"),
        "price_pairs": distribution.pair_counts(
            lines, "initial_price", "final_price", F.avg("discount_rate_adjusted").alias("avg_discount")
        ),
        "order_value_bins": distribution.histogram_2d(spread, "order_count", "log_aov", by=["customer_type"]),
        "order_amount_quantiles": distribution.qq_values(
            cleaning.valid_amount(store.read("orders")), "total_amount"
        ),
        "summary_metrics": reports.summary_metrics(lines, products),
        "overall_summary": reports.overall_summary(days),
        "price_distribution": cleaning.price_band_report(
            cleaning.valid_price(products), "final_price", cleaning.TENS_EDGES, cleaning.TENS_LABELS,
            right=False, weight="line_count",
        ),
        "top5_categories": reports.top(reports.category_sales(products), 5, "total_qty", "root_category"),
        "color_preference": reports.value_counts(products, "color"),
        "size_distribution": reports.value_counts(products, "size"),
        "brand_top10": reports.top(reports.brand_summary(products), 10, "items", "brand"),
        "category_reach": reports.top_with_ties(reports.category_reach(lines), 50, "items"),
        "segment_counts": reports.segment_counts(rfm),
        "segment_share": reports.segment_share(store.read("customer_cluster_result"), names),
        "segment_sales_share": reports.segment_sales_share(days, names),
        "daily_by_segment": reports.daily_by_segment(days),
        "repeat_purchase_days": reports.repeat_purchase_days(days),
        "cohort_retention": reports.cohort_retention(days, 90, years),
        "brands_per_category": reports.brands_per_category(products),
        "channel_region": reports.channel_region(days),
        "region_sales": reports.region_sales(days),
        "stock_effect": reports.stock_effect(lines),
        "rating_sales": reports.rating_sales(products),
        "content_richness": reports.content_richness(products),
        "status_distribution": reports.status_distribution(lines),
        "category_sales_share": reports.top_and_other(products, total("sales")),
        "category_qty_share": reports.top_and_other(products, total("quantity")),
        "top20_orders": reports.top_orders(lines),
        "top10_products": reports.top_products(products),
        "order_frequency_fit": distribution.frequency_fit(reports.order_frequency(store.read("orders"))),
        "order_amount_qq": distribution.qq_normal(cleaning.valid_amount(store.read("orders")), "total_amount"),
        "price_histogram": distribution.histogram(
            cleaning.valid_price(products), "final_price", 60, "line_count"
        ),
        "spend_box": distribution.box_stats(
            rfm.filter(F.col("customer_type").isNotNull()), "monetary", ["customer_type"]
        ),
    }
    for name, table in tables.items():
        store.result(table, f"report/{name}")

"""The chain of stages over the smallest tables."""

import pytest
from pyspark.sql import functions as F

from tillroll.plans import stages
from tillroll.sources.star import load_star

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    star = load_star(spark, SF_DIR)
    s = stages.Store(spark, str(tmp_path_factory.mktemp("stages")))
    s.write(star.customers, "customers")
    raw = star.products.withColumn(
        "color", F.when(F.col("product_id") == 3, "N/A").otherwise(F.col("color"))
    ).drop("discount_rate")
    stages.clean_catalog(s, raw.withColumnRenamed("model_number", "sku"), ["sku"])
    lines = star.lines.select("order_id", "product_id", "quantity").filter("product_id > 0")
    stages.price_orders(s, lines, star.orders)
    stages.build_fact(s)
    stages.segment_customers(s, restarts=3, k_max=3)
    stages.write_back(s)
    stages.segment_products(s, restarts=3, k_max=3)
    stages.forecast_monthly(s, "amount", before="2001-08-01")
    stages.forecast_monthly(s, "qty", ["root_category"], boosted=False, before="2001-08-01")
    stages.report(s, "2002-01-01", (1995, 1996))
    return s


def test_catalog_is_renumbered(store):
    products = store.read("products")
    n = products.count()
    assert n == 199
    assert products.agg(F.min("product_id"), F.max("product_id"), F.count_distinct("product_id")).first() == (1, n, n)
    assert products.filter(F.col("color_group").isNull()).count() == 0


def test_fact_keeps_every_line(store):
    assert store.read("fact").count() == store.read("order_items").count()
    assert store.read("fact_with_clusters").count() == store.read("order_items").count()


def test_order_totals_add_up(store):
    orders = store.read("orders")
    items = store.read("order_items").groupBy("order_id").agg(F.sum("line_total").alias("s"))
    off = orders.join(items, "order_id").filter(
        F.abs(F.col("total_amount") - F.col("shipping_fee") - F.col("s")) > 0.006
    )
    assert off.count() == 0


def test_segments_rise_with_spend(store):
    rows = store.read("customer_cluster_result").orderBy("cluster").collect()
    spend = [r["avg_total_spend"] for r in rows]
    assert [r["cluster"] for r in rows] == [1, 2, 3] and spend == sorted(spend)
    labelled = store.read("fact_with_clusters").filter(F.col("customer_id").isNotNull())
    assert labelled.filter(F.col("customer_type").isNull()).count() == 0


def test_every_series_has_scores_and_a_future(store):
    for measure, n in (("amount", 1), ("qty", 6)):
        ranking = store.read(f"model_ranking_{measure}")
        assert ranking.filter("rmse < mae - 1e-6").count() == 0
        assert store.read(f"future_{measure}").groupBy("series_key").count().collect() and (
            store.read(f"future_{measure}").count() == 6 * n
        )


def test_reports_agree_with_the_fact(store):
    lines = store.read("fact_with_clusters")
    whole = lines.agg(F.sum("line_total")).first()[0]
    for name, column in (("region_sales", "sales"), ("category_sales_share", "value"), ("status_distribution", "sales")):
        got = store.read(f"report/{name}").agg(F.sum(column)).first()[0]
        assert got == pytest.approx(whole)
    retained = store.read("report/cohort_retention")
    assert retained.agg(F.max("retention")).first()[0] == 1.0
    csv = store.spark.read.option("header", True).csv(store.path("report/brand_top10.csv"))
    assert csv.count() == 10


def test_the_best_model_leads_the_ranking(store):
    """Among all twelve models where the trees were fitted too."""
    assert store.read("model_ranking_amount").select("model").distinct().count() == 12
    for measure in ("amount", "qty"):
        best = {r["series_key"]: r["model"] for r in store.read(f"best_model_{measure}").collect()}
        ranking = store.read(f"model_ranking_{measure}").orderBy("series_key", "rmse", "model").collect()
        first = {}
        for r in ranking:
            first.setdefault(r["series_key"], r["model"])
        assert best == first
        future = {(r["series_key"], r["model"]) for r in store.read(f"future_{measure}").collect()}
        assert future == set(best.items())


def test_segment_labels_are_one_row_each_in_the_csv(store):
    from tillroll.sources.files import read_result_csv

    table = store.read("report/segment_share")
    back = read_result_csv(store.spark, store.path("report/segment_share.csv"), table.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))

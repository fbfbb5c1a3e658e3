"""Co-partitioned tables, observed writes and roll-ups: what the plans hold and what comes out."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators import features
from tillroll.plans import load
from tillroll.sources import contracts
from tillroll.sources.buckets import SALT, store_pair
from tillroll.sources.star import load_star

SF_DIR = "/root/testdata/sf0.001"
QUERIES, _ = load()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_stored_lines_meet_orders_without_an_exchange(spark, no_broadcast):
    star = load_star(spark, SF_DIR)
    pair = store_pair(star.lines, star.orders, "order_id", buckets=6)
    joined = pair.joined(["product_id", "quantity"], ["customer_id", "order_date"])
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert text.count("SelectedBucketsCount: 6 out of 6") == 2
    want = star.lines.join(star.orders, "order_id", "left").select(joined.columns)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect()))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert len(scans) == 2 and not any("shipping_fee" in s or "unit_price" in s for s in scans)
    pair.forget()


def test_orders_meet_customers_in_buckets_of_the_customer(spark, no_broadcast):
    star = load_star(spark, SF_DIR)
    pair = store_pair(star.orders, star.customers, "customer_id", buckets=4, hot=[])
    text = plan(pair.joined())
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_hot_and_missing_keys_are_spread_over_buckets(spark, no_broadcast):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id"))
    lines = spark.range(6000).select(key.cast("long").alias("order_id"), (F.col("id") % 2).alias("x"))
    orders = spark.range(6000).select(F.col("id").alias("order_id"), (F.col("id") * 2).alias("owner"))
    pair = store_pair(lines, orders, "order_id", buckets=8)
    joined = pair.joined()
    assert "Exchange" not in plan(joined)
    rows = Counter(map(tuple, joined.collect()))
    want = Counter(map(tuple, lines.join(orders, "order_id", "left").select(joined.columns).collect()))
    assert rows == want and sum(rows.values()) == 6000
    per_task = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(per_task) == 8 and max(per_task) < 2 * 6000 / 8
    assert spark.table(pair.left).filter("order_id = 7").select(SALT).distinct().count() > 8


def test_a_written_table_is_checked_with_one_look_at_its_source(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def looked_at(i):
        seen.add(1)
        return i

    source = spark.range(1000).select(looked_at("id").alias("k"), (F.col("id") % 5).alias("x"), F.lit("t").alias("t"))
    path = str(tmp_path / "copy")
    report = contracts.write_verified(source, F.when(F.col("x") > 0, F.col("x") > 1), path, "k", "numbers").first()
    assert seen.value == 1000
    want = {"rows_before": 1000, "keys_before": 1000, "rows_expected": 600, "keys_expected": 600, "rows_written": 600,
            "keys_written": 600, "columns_expected": 3, "columns_written": 3, "ok": True, "table": "numbers"}
    assert report.asDict() == want
    copy = spark.read.parquet(contracts.accepted(path))
    assert copy.columns == ["k", "x", "t"] and copy.count() == 600
    assert spark.read.parquet(f"{path}/_kept=false").filter("x is not null or t is not null").count() == 0


def test_a_damaged_copy_is_noticed(spark, tmp_path):
    path = str(tmp_path / "copy")
    source = spark.range(100).select(F.col("id").alias("k"))
    report = contracts.write_verified(source, F.col("k") < 90, path, "k", "numbers")
    spark.range(5).select(F.col("id").alias("k")).write.mode("append").parquet(contracts.accepted(path))
    spark.catalog.refreshByPath(path)
    row = report.first()
    assert not row["ok"] and (row["rows_expected"], row["rows_written"]) == (90, 95) or row["rows_written"] == 90
    nothing = contracts.write_verified(source, F.lit(False), str(tmp_path / "none"), "k", "numbers").first()
    assert (nothing["rows_written"], nothing["rows_expected"], nothing["ok"]) == (0, 0, True)


@pytest.mark.parametrize("name", ["cust_item_features", "prod_sales_features"])
def test_distinct_counts_copy_no_line(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Expand" not in text and "count(distinct" not in text


def test_distinct_counts_with_missing_values(spark):
    rows = [
        (1, 10, "a", 100, 5, "2024-01-01", 1.0, 2.0, 0.1), (1, 10, "a", 101, 5, None, None, 3.0, None),
        (1, None, None, 101, 5, "2024-01-01", 2.0, None, 0.0), (1, 11, None, 102, 6, "2024-01-02", 2.0, 1.0, 0.2),
        (None, 10, "b", 103, None, None, 1.0, 1.0, None), (2, 10, None, None, 7, None, None, None, None),
    ]
    kind = (
        "customer_id int, product_id int, category string, order_id int, other int, order_date string, "
        "quantity double, line_total double, discount_rate_adjusted double"
    )
    fact = spark.createDataFrame(rows, kind).withColumn("order_date", F.to_date("order_date"))
    fact = fact.withColumn("unit_price", F.col("line_total")).repartition(3)
    got = {r["customer_id"]: r for r in features.customer_item_features(fact).collect()}
    counts = {k: (r["unique_product_count"], r["category_diversity"], r["frequency"]) for k, r in got.items()}
    assert counts == {1: (3, 1, 3), None: (1, 1, 1), 2: (1, 0, 1)}
    assert (got[1]["total_quantity"], got[1]["avg_quantity_per_order"], got[1]["discounted_item_ratio"]) == (5, 5 / 3, 2 / 3)
    assert (got[2]["total_quantity"], got[2]["avg_line_total"], got[2]["discounted_item_ratio"]) == (0, None, None)
    sold = {r["product_id"]: r for r in features.product_sales_features(fact).collect()}
    counts = {k: (r["order_count"], r["customer_count"], r["frequency"]) for k, r in sold.items()}
    assert counts == {10: (4, 3, 2), None: (1, 1, 1), 11: (1, 1, 1)}

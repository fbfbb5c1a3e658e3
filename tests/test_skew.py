"""Hot keys, exact ranks and quantiles against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.functions import ranking, selection, skew
from tillroll.operators import fact, reports


@pytest.fixture(scope="module")
def hot_lines(spark):
    """A third of the lines on product 0, some of them equal in every column."""
    return spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 701).alias("product_id"),
        (F.col("id") % 5).alias("quantity"),
    )


def test_hot_keys_are_found(hot_lines):
    assert 0 in skew.hot_keys(hot_lines, "product_id")["product_id"]


def test_salted_join_equals_plain_join(spark, hot_lines):
    right = spark.range(500).select(F.col("id").alias("product_id"), (F.col("id") * 2).alias("v"))
    hot = skew.hot_keys(hot_lines, "product_id")["product_id"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = skew.salted_left_join(hot_lines, right, ["product_id"], hot)
        want = hot_lines.join(right, "product_id", "left")
        assert got.count() == 30000
        assert got.select(*want.columns).exceptAll(want).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copies_of_a_hot_line_are_spread_over_tasks(spark, hot_lines):
    right = spark.range(500).select(F.col("id").alias("product_id"), (F.col("id") * 2).alias("v"))
    lines = skew.with_line_id(hot_lines.withColumn("quantity", F.lit(1)))
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        joined = skew.salted_left_join(lines, right, ["product_id"], [0])
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in per_task) < 30000 / 3
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_missing_keys_survive(spark):
    left = spark.createDataFrame([(None, 1), (5, 2)], "k int, x int")
    right = spark.createDataFrame([(5, "five")], "k int, v string")
    got = skew.salted_left_join(left, right, ["k"], [5]).orderBy("x").collect()
    assert [(r["k"], r["v"]) for r in got] == [(None, None), (5, "five")]


def test_row_numbers_have_no_gaps(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"))
    got = sorted((r["k"], r["n"]) for r in ranking.row_numbers(df, [F.col("k").asc()], "n").collect())
    assert got == [(i, i + 1) for i in range(5000)]


@pytest.mark.parametrize("weighted", [False, True])
def test_quantiles_are_exact(spark, weighted):
    rng = np.random.default_rng(7)
    values = {"a": np.round(rng.lognormal(2, 1, 4000), 1), "b": rng.normal(size=7), "c": np.ones(3)}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    weight = None
    if weighted:
        df = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("w"))
        weight = "w"
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["p"]): r["q"] for r in selection.quantiles(df, "v", probs, ["g"], weight).collect()}
    for g, vs in values.items():
        for p in probs:
            assert got[g, p] == pytest.approx(np.quantile(vs, p)), (g, p)


def test_quantiles_with_a_missing_group_and_nan(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("x", float("nan")), ("x", 2.0)], "g string, v double")
    got = {r["g"]: r["q"] for r in selection.quantiles(df, "v", [0.5], ["g"]).collect()}
    assert got == {None: 2.0, "x": 2.0}


def test_roll_ups_give_the_same_reports(spark):
    lines = spark.createDataFrame(
        [(1, 10, 2.0, 5.0), (1, 11, 1.0, 3.0), (2, 10, 4.0, 7.0)],
        "order_id int, product_id int, quantity double, line_total double",
    )
    products = spark.createDataFrame(
        [(10, "A", 8.0, 0.5), (11, "B", None, 0.1)],
        "product_id int, root_category string, final_price double, discount_rate double",
    )
    flat = lines.join(products, "product_id", "left")
    rolled = fact.product_grain(lines, products)
    key = lambda r: r["root_category"]
    a = sorted(reports.category_sales(flat).collect(), key=key)
    b = sorted(reports.category_sales(rolled).collect(), key=key)
    assert a == b


@pytest.fixture
def plain_joins(spark):
    """Shuffle joins as planned: no broadcast, nothing coalesced or split at run time."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def largest_share(df):
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / (sum(counts) / 8)


def test_rows_without_a_key_are_spread(plain_joins):
    lines = plain_joins.range(80000).select(
        F.when(F.col("id") % 2 == 0, F.col("id") % 4001).alias("k"), F.col("id").alias("x")
    )
    right = plain_joins.range(4001).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert largest_share(skew.salted_left_join(lines, right, ["k"], [])) < 2


def test_the_customer_of_a_hot_order_is_spread(plain_joins, tmp_path):
    spark = plain_joins
    lines = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5003).alias("order_id"),
        (F.col("id") % 97).alias("product_id"), F.col("id").alias("x"),
    )
    lines.write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))
    orders = spark.range(5003).select(F.col("id").alias("order_id"), (F.col("id") % 1009).alias("customer_id"))
    customers = spark.range(1009).select(F.col("id").alias("customer_id"), (F.col("id") * 2).alias("age"))
    products = spark.range(97).select(F.col("id").alias("product_id"))
    hot = fact.line_hot_keys(lines, orders)
    assert 7 in hot["order_id"] and 7 in hot["customer_id"]
    joined = fact.combine(lines, orders, customers, products, ["x", "age"], hot)
    assert joined.filter(F.col("age").isNull()).count() == 0
    assert largest_share(joined) < 2


def test_no_job_runs_while_the_fact_is_planned(spark, hot_lines):
    lines = hot_lines.withColumn("order_id", F.col("quantity"))
    orders = spark.range(5).select(F.col("id").alias("order_id"), F.col("id").alias("customer_id"))
    customers = spark.range(5).select(F.col("id").alias("customer_id"), F.lit(1).alias("age"))
    products = spark.range(701).select(F.col("id").alias("product_id"), F.lit("a").alias("color"))
    hot = {"order_id": [], "product_id": [0], "customer_id": []}
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    fact.combine(lines, orders, customers, products, hot=hot)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(before)

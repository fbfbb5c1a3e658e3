"""What the physical plans must and must not contain."""

import re

from tillroll.operators import cleaning, fact, reports
from tillroll.plans import load
from tillroll.sources.files import write_table
from tillroll.sources.star import load_star

SF_DIR = "/root/testdata/sf0.001"
QUERIES, _ = load()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_the_report_needs(spark):
    text = plan(QUERIES["top5_categories"](spark, SF_DIR))
    scan = next(s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "l_" in s)
    assert set(re.findall(r"(l_\w+):", scan)) == {"l_partkey", "l_quantity", "l_extendedprice", "l_discount"}


def test_date_filter_reaches_the_scan(spark):
    star = load_star(spark, SF_DIR)
    text = plan(star.orders.filter("total_amount > 100000").select("order_id"))
    assert "GreaterThan(o_totalprice,100000.0)" in text


def test_unused_dimensions_are_not_joined(spark):
    star = load_star(spark, SF_DIR)
    lean = fact.combine(star.lines, star.orders, star.customers, star.products, ["line_total", "order_date"])
    assert len(re.findall(r"(?:BroadcastHash|SortMerge)Join", plan(lean))) == 1


def test_lines_are_added_up_before_the_exchange(spark):
    star = load_star(spark, SF_DIR)
    text = plan(fact.order_grain(star.lines, star.orders))
    assert text.index("partial_sum") > text.index("Exchange")  # the deeper node prints later


def test_top_list_is_not_a_full_sort(spark):
    star = load_star(spark, SF_DIR)
    assert "TakeOrderedAndProject" in plan(reports.top_products(star.lines))


def test_brand_ranking_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["top20_brand_per_category"](spark, SF_DIR))


def test_period_reads_only_its_months(spark, tmp_path):
    star = load_star(spark, SF_DIR)
    path = str(tmp_path / "orders")
    write_table(star.orders.withColumn("order_month", reports.month_of()), path, ["order_month"])
    df = cleaning.period(spark.read.parquet(path), "1996-02-10", "1996-03-05", "order_date")
    filters = re.search(r"PartitionFilters: \[([^\n]*)\], PushedFilters", plan(df)).group(1)
    assert "order_month" in filters
    assert len(df.inputFiles()) > 2
    want = star.orders.filter("order_date between date'1996-02-10' and date'1996-03-05'").count()
    assert df.count() == want


def test_large_sides_are_not_broadcast(spark):
    """Beyond the broadcast limit the fact is built with shuffled joins."""
    star = load_star(spark, SF_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(fact.combine(star.lines, star.orders, star.customers, star.products))
        assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") >= 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

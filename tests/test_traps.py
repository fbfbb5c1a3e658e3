"""Small literal tables for the cases the fixture does not hold."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tillroll.functions import columns as fc
from tillroll.operators import cleaning, fact, features, reports, terms
from tillroll.operators import series as ts
from tillroll.sources import contracts, files


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_sum_of_missing_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0)], "k int, x double")
    got = dict(values(df.groupBy("k").agg(fc.total("x").alias("s")), "k", "s"))
    assert got == {1: 0.0, 2: 3.0}


def test_distinct_counts_missing_once(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, None), (2, "b")], "k int, x string")
    got = dict(values(df.groupBy("k").agg(fc.distinct_with_missing("x").alias("n")), "k", "n"))
    assert got == {1: 2, 2: 1}


def test_first_known_follows_the_order(spark):
    df = spark.createDataFrame(
        [(1, 3, "c"), (1, 1, None), (1, 2, "b")], "k int, i int, x string"
    )
    assert values(df.groupBy("k").agg(fc.first_known("x", "i").alias("x")), "x") == [("b",)]


@pytest.mark.parametrize(
    "initial, final, expected",
    [
        (None, 5.0, 0.0), (5.0, None, 0.0), (0.0, 5.0, 0.0), (-1.0, 5.0, 0.0),
        (10.0, 12.0, 0.0), (10.0, 10.0, 1.0), (10.0, 4.0, 0.4), (10.0, 0.0, 10.0),
        (10.0, -2.0, 12.0),
    ],
)
def test_paid_ratio(spark, initial, final, expected):
    df = spark.createDataFrame([(initial, final)], "initial_price double, final_price double")
    assert cleaning.with_paid_ratio(df).first()["discount_rate"] == pytest.approx(expected)


def test_corrected_paid_ratio(spark):
    df = spark.createDataFrame(
        [(10.0, 12.0), (10.0, 4.0), (None, 1.0), (10.0, -1.0)], "initial_price double, final_price double"
    )
    got = [r[0] for r in values(cleaning.with_paid_ratio(df, corrected=True), "discount_rate")]
    assert got == [1.0, pytest.approx(0.4), None, 0.0]


def test_band_edges(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (100.0,), (200.0,), (250.0,)], "p double")
    right = fc.price_band("p", cleaning.WIDE_EDGES, cleaning.WIDE_LABELS, True)
    left = fc.price_band("p", cleaning.TENS_EDGES, cleaning.TENS_LABELS, False)
    assert [r[0] for r in df.select(right).collect()] == [None, "$0-10", "$50-100", "$100-200", "$200+"]
    assert [r[0] for r in df.select(left).collect()] == ["0-10", "10-20", "100+", "100+", "100+"]


def test_safe_numbers(spark):
    df = spark.createDataFrame([("x",), (None,), ("-3",), ("0.5",), ("7",)], "s string")
    got = values(df.select(fc.safe_rate("s").alias("r"), fc.safe_price("s").alias("p")), "r", "p")
    assert got == [(0.0, 0.01), (0.0, 0.01), (0.0, 0.01), (0.5, 0.5), (0.9, 7.0)]


def test_finite_or_zero(spark):
    xs = [None, math.nan, math.inf, -math.inf, 2.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r[0] for r in values(cleaning.finite_features(df, ["x"]), "x")] == [0, 0, 0, 0, 2.5]


def test_complete_rows_fills_only_infinities(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (math.inf, math.inf)], "a double, b double")
    assert sorted(values(cleaning.complete_rows(df, ["a", "b"], {"b": 9999}), "a", "b")) == [
        (0.0, 9999.0), (1.0, 2.0)]


def test_line_total_is_paid_share_in_cents(spark):
    df = spark.createDataFrame(
        [(2, 10.0, 0.5), (1, 10.0, 0.0), (1, 1.005, 1.0), (3, 10.0, 1.5)],
        "quantity int, unit_price double, discount_rate double",
    )
    got = [r[0] for r in values(cleaning.price_lines(df), "line_total")]
    assert got == [10.0, 0.0, 1.01, 0.0]


def test_title_case(spark):
    df = spark.createDataFrame([("blue-green sea",), ("plain",)], "s string")
    assert [r[0] for r in df.select(fc.title_case("s")).collect()] == ["Blue-Green Sea", "Plain"]


def test_formats(spark):
    row = spark.range(1).select(
        fc.comma(F.lit(1234567)), fc.dollar(F.lit(1234.5)), fc.percent(F.lit(0.12345))
    ).first()
    assert tuple(row) == ("1,234,567", "$1,234.50", "12.3%")


PALETTE = (("default", ("odd thing",)), ("Green", ("green", "blackish green")), ("Black", ("natural black",)))


@pytest.mark.parametrize(
    "text, listed, closest",
    [
        ("GREEN", "Green", "Green"), ("  dark   green ", "Green", "Green"),
        ("black", "Green", "Black"), ("odd thin", "default", "default"),
        ("magenta-ish hue", "Magenta-Ish Hue", "Magenta-Ish Hue"), ("  ", None, None), (None, None, None),
    ],
)
def test_color_group(spark, text, listed, closest):
    df = spark.createDataFrame([(1, text)], "id int, color string")
    assert terms.classify_terms(df, "color", PALETTE).first()["color_group"] == listed
    near = terms.classify_terms(df, "color", PALETTE, prefer="closest").first()["color_group"]
    # "natural black" and "blackish green" both hold "black"; the shorter is nearer.
    assert near == closest


def test_placeholder_rows(spark):
    df = spark.createDataFrame([("n/a",), (" N/A ",), (None,), ("red",)], "color string")
    assert values(cleaning.drop_placeholder(df, "color"), "color") == [("red",)]


def test_catalog_csv_missing_tokens(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('id,name,price\n1,"a, ""b""",2.5\n2,NA,null\n3, x ,oops\n', encoding="utf-8")
    schema = spark.createDataFrame([], "id bigint, name string, price double").schema
    got = values(files.read_catalog_csv(spark, str(path), schema), "id", "name", "price")
    assert sorted(got) == [(1, 'a, "b"', 2.5), (2, None, None), (3, "x", None)]


def test_required_columns(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="price"):
        contracts.require_columns(df, ["id", "price"])
    with pytest.warns(UserWarning, match="price"):
        assert contracts.require_columns(df, ["id", "price"], strict=False) == ["price"]


def test_empty_input_fails(spark):
    orders = spark.createDataFrame([], "order_id int")
    with pytest.raises(Exception, match="no orders"):
        contracts.check_detail_total(orders, orders).collect()


def test_order_totals_fee_rules(spark):
    orders = spark.createDataFrame(
        [(i, 1, dt.date(2024, 1, 1), "F", 0.0, 9.0) for i in (1, 2, 3, 4)],
        "order_id int, customer_id int, order_date date, order_status string, total_amount double, "
        "shipping_fee double",
    )
    lines = spark.createDataFrame(
        [(1, 20.0, True), (1, 5.0, False), (2, 4.0, False), (3, 50.0, False)],
        "order_id int, line_total double, free_shipping boolean",
    )
    got = {r["order_id"]: (r["shipping_fee"], r["total_amount"]) for r in fact.roll_up_orders(orders, lines).collect()}
    assert got == {1: (0.0, 25.0), 2: (4.0, 8.0), 3: (9.0, 59.0), 4: (None, None)}


def test_combine_takes_the_line_value_first(spark):
    lines = spark.createDataFrame(
        [(1, 7, 9, None, None), (2, 7, 9, 0.5, True)],
        "order_id int, customer_id int, product_id int, discount_rate double, free_shipping boolean",
    )
    orders = spark.createDataFrame([(1, 7, "A"), (2, 8, "B")], "order_id int, customer_id int, order_status string")
    customers = spark.createDataFrame([(7, "X")], "customer_id int, region string")
    products = spark.createDataFrame(
        [(9, 0.2, False, "b")], "product_id int, discount_rate double, free_shipping boolean, brand string"
    )
    got = {r["order_id"]: r for r in fact.combine(lines, orders, customers, products).collect()}
    assert (got[1]["discount_rate"], got[1]["free_shipping"], got[1]["order_status"]) == (0.2, False, "A")
    # Line and order disagree on the customer: no order columns.
    assert (got[2]["discount_rate"], got[2]["free_shipping"], got[2]["order_status"]) == (0.5, True, None)
    assert got[2]["region"] == "X"


def test_rating_bounds(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 0.0), (2, 100.0, 50.0), (3, 50.0, 100.0), (4, 10.0, None)],
        "product_id int, quantity double, avg_price double",
    )
    got = dict(values(features.product_rating(df), "product_id", "rating"))
    # Product 3: 0.7 * 0.5 + 0.3 * 0.5 = 0.5, and 2.5 stars round up.
    assert got == {1: 1, 2: 5, 3: 3, 4: None}


def test_top_with_ties(spark):
    df = spark.createDataFrame([("a", 3), ("b", 2), ("c", 2), ("d", 1)], "k string, n int")
    assert sorted(values(reports.top_with_ties(df, 2, "n"), "k")) == [("a",), ("b",), ("c",)]
    assert sorted(values(reports.top(df, 2, "n", "k"), "k")) == [("a",), ("b",)]


def test_top_and_other_keeps_the_total(spark):
    df = spark.createDataFrame([(f"c{i}", float(i)) for i in range(9)] + [(None, 99.0)], "root_category string, line_total double")
    got = reports.top_and_other(df, fc.total("line_total"), n=5).collect()
    assert sum(r["value"] for r in got) == 36.0
    assert sum(r["pct"] for r in got) == pytest.approx(1)
    assert {r["root_category"] for r in got} == {"c8", "c7", "c6", "c5", "c4", "Other"}


def test_stock_ordinal_puts_unstocked_last(spark):
    df = spark.createDataFrame(
        [("a", True, 1.0, 1), ("b", False, 9.0, 2), ("c", True, 5.0, 3)],
        "root_category string, in_stock boolean, line_total double, order_id int",
    )
    got = dict(values(reports.stock_effect(df), "root_category", "category_ord"))
    assert got == {"c": 1, "a": 2, "b": 3}


def test_retention_starts_at_one_and_never_exceeds_it(spark):
    rows = [(c, dt.date(2024, 1, d)) for c, d in ((1, 1), (1, 5), (2, 1), (3, 2), (3, 3))]
    df = spark.createDataFrame(rows, "customer_id int, order_date date")
    got = {r["days_since_first"]: r["retention"] for r in reports.cohort_retention(df, 90, (2024,)).collect()}
    assert got[0] == 1.0 and max(got.values()) == 1.0 and got[4] == pytest.approx(1 / 3)


def test_months_without_gaps(spark):
    rows = [("a", dt.date(2023, 11, 1), 1.0), ("a", dt.date(2024, 2, 1), None), ("b", dt.date(2024, 5, 1), 2.0)]
    df = spark.createDataFrame(rows, "series_key string, month date, y double")
    got = sorted(values(ts.complete_months(df), "series_key", "month", "y"))
    assert got == [
        ("a", dt.date(2023, 11, 1), 1.0), ("a", dt.date(2023, 12, 1), 0.0),
        ("a", dt.date(2024, 1, 1), 0.0), ("a", dt.date(2024, 2, 1), 0.0),
        ("b", dt.date(2024, 5, 1), 2.0),
    ]


def test_calendar_defaults(spark):
    rows = [("a", dt.date(2025, 12, 1), 100.0), ("b", dt.date(2024, 7, 1), 100.0)]
    df = spark.createDataFrame(rows, "series_key string, month date, y double")
    got = dict(values(ts.apply_calendar(df), "series_key", "y"))
    assert got["a"] == pytest.approx(100 * 1.025 * 1.2 * 1.35 * 1.3)
    assert got["b"] == pytest.approx(100 * 1.025 * 1.1 * 1.2 * 1.2)


def test_short_series_are_marked(spark):
    rows = [("a", dt.date(2024, 1 + i, 1), 1.0) for i in range(6)]
    df = spark.createDataFrame(rows, "series_key string, month date, y double")
    assert {r["part"] for r in ts.split(df).collect()} == {"short"}

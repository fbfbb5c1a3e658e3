"""Order statistics on counting grids against numpy, with many small passes."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions import selection
from tillroll.operators import distribution
from tillroll.sources import contracts

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
RNG = np.random.default_rng(11)
GROUPS = {
    "heavy": RNG.pareto(0.5, 3000),
    "both signs": np.round(RNG.normal(0, 50, 3000), 1),
    "hot value": np.concatenate([np.full(2000, 7.25), RNG.uniform(7, 8, 1000)]),
    "far apart": np.array([-1e300, -1e-300, 0.0, -0.0, 5e-324, 1.0, 1e300, 1.0 + 2e-16]),
    "close": 1e9 + np.arange(500) / 64,
    "one": np.array([3.5]),
    None: np.array([2.0, 1.0]),
}


def table(spark, groups):
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("one", float("nan")), ("one", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


@pytest.mark.parametrize("few_cells", [0, 1 << 14])
@pytest.mark.parametrize(("few_rows", "fine"), [(1 << 20, 4096), (8, 4), (0, 3)])
def test_quantiles_after_any_number_of_passes(spark, monkeypatch, few_rows, fine, few_cells):
    monkeypatch.setattr(selection, "FEW_ROWS", few_rows)
    monkeypatch.setattr(selection, "FINE", fine)
    monkeypatch.setattr(selection, "FEW_CELLS", few_cells)
    groups = GROUPS if fine > 4 else {g: v[:200] for g, v in GROUPS.items()}
    got = {(r["g"], r["p"]): r["q"] for r in selection.quantiles(table(spark, groups), "v", PROBS, ["g"]).collect()}
    assert len(got) == len(groups) * len(PROBS)
    for g, values in groups.items():
        for p in PROBS:
            assert got[g, p] == pytest.approx(np.quantile(values, p), rel=1e-12), (g, p)


def test_no_rows_and_no_groups(spark):
    df = table(spark, {"a": np.arange(10.0)})
    assert selection.quantiles(df.limit(0), "v", [0.5], ["g"]).count() == 0
    assert [tuple(r) for r in selection.quantiles(df, "v", [0.5]).collect()] == [(0.5, 4.5)]


def test_infinite_values(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,), (2.0,), (float("inf"),)], "v double")
    got = {r["p"]: r["q"] for r in selection.quantiles(df, "v", [0.25, 0.5, 1.0]).collect()}
    assert got == {0.25: 1.0, 0.5: 2.0, 1.0: float("inf")} or np.isnan(got[1.0])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=2, max_size=2))
def test_cells_never_fall(values):
    """The formula of the first grid, in Python."""

    def cell(v):
        if v == 0:
            return 0
        octave = min(max(np.log2(abs(v)), -selection.EXPONENTS), selection.EXPONENTS)
        place = int(np.floor(octave * selection.PER_OCTAVE)) + selection.EXPONENTS * selection.PER_OCTAVE + 1
        return place if v > 0 else -place

    low, high = sorted(values)
    assert cell(low) <= cell(high)


def test_grid_stays_small(spark):
    rows = selection.known_values(spark.range(200_000).select((F.col("id") / 7).alias("v")), "v")
    grid = selection.first_grid(rows, 0)
    assert grid.count() < 64 * 20
    assert grid.agg(F.sum("n"), F.max("total"), F.min("lo"), F.max("hi")).first()[:3] == (200_000, 200_000, 0.0)


@pytest.mark.parametrize("weighted", [False, True])
def test_boxes_by_hand(spark, weighted):
    df = table(spark, {g: v for g, v in GROUPS.items() if g != "far apart"})
    weight = None
    if weighted:
        df, weight = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("w")), "w"
    got = {r["g"]: r for r in distribution.box_stats(df, "v", ["g"], weight).collect()}
    for g, r in got.items():
        v = GROUPS[g]
        q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        kept = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, q2, q3))
        assert (r["n"], r["min"], r["max"], r["outliers"]) == (len(v), v.min(), v.max(), len(v) - len(kept))
        assert (r["whisker_low"], r["whisker_high"]) == (kept.min(), kept.max())
    assert got.keys() == GROUPS.keys() - {"far apart"}


def test_profile_is_exact_unless_asked_otherwise(spark):
    df = spark.range(1001).select(F.pow(F.col("id"), 2).alias("x"), F.col("id").alias("y"))
    got = {r["column"]: r for r in contracts.profile(df, ["x", "y"]).collect()}
    assert (got["x"]["q1"], got["x"]["median"], got["x"]["q3"]) == (250.0**2, 500.0**2, 750.0**2)
    assert got["y"]["median"] == 500 and got["y"]["n_missing"] == 0

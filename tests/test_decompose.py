"""Robust decomposition: a single outlier stays in the remainder."""

import datetime as dt

import numpy as np
import pytest

from tillroll.operators import series as ts

SEASON = 30 * np.sin(np.arange(12) * np.pi / 6)


def table(spark, series):
    rows = [(k, dt.date(2000 + i // 12, i % 12 + 1, 1), float(v)) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "series_key string, month date, y double")


def parts(spark, series, decompose=ts.robust_decompose):
    out = {}
    for r in decompose(table(spark, series)).orderBy("series_key", "month").collect():
        out.setdefault(r["series_key"], []).append(r)
    return out


@pytest.fixture(scope="module")
def plain():
    rng = np.random.default_rng(3)
    t = np.arange(96)
    return 500 + 2.0 * t + SEASON[t % 12] + rng.normal(0, 2, 96)


def test_one_outlier_moves_trend_and_season_little(spark, plain):
    hit = plain.copy()
    hit[40] += 400
    found = parts(spark, {"plain": plain, "hit": hit})
    classical = parts(spark, {"plain": plain, "hit": hit}, ts.decompose)

    def moved(found, part):
        pairs = zip(found["plain"], found["hit"], strict=True)
        return max(abs(a[part] - b[part]) for a, b in pairs if a[part] is not None)

    # Two in a hundred of the outlier at most.
    assert moved(found, "trend") < 8 and moved(found, "seasonal") < 8
    assert moved(classical, "trend") > 20 and moved(classical, "seasonal") > 20
    assert found["hit"][40]["weight"] == 0 and found["hit"][40]["remainder"] > 390
    assert sum(r["weight"] > 0.5 for r in found["hit"]) > 80


def test_parts_add_up_and_follow_what_was_planted(spark, plain):
    found = parts(spark, {"plain": plain})["plain"]
    t = np.arange(96)
    assert np.allclose([r["trend"] + r["seasonal"] + r["remainder"] for r in found], plain)
    assert np.abs(np.array([r["seasonal"] for r in found]) - SEASON[t % 12]).max() < 4
    assert np.abs(np.array([r["trend"] for r in found]) - (500 + 2.0 * t)).max() < 4
    assert abs(np.mean([r["seasonal"] for r in found[:12]])) < 1e-9


def test_short_flat_and_no_series(spark):
    found = parts(spark, {"flat": np.full(30, 5.0), "short": np.array([1.0, 2.0, 4.0]), "one": np.array([3.0])})
    assert all(r["trend"] == pytest.approx(5) and r["remainder"] == pytest.approx(0) for r in found["flat"])
    assert len(found["short"]) == 3 and len(found["one"]) == 1
    assert ts.robust_decompose(table(spark, {"x": []})).count() == 0

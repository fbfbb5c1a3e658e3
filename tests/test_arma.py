"""Seasonal ARMA: regressions against numpy, planted orders, and the differences chosen."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import arma
from tillroll.operators.forecast import windows


def simulated(rng, n, ar=(), ma=(), seasonal=0.0):
    e, x = rng.normal(size=n + 200), np.zeros(n + 200)
    for t in range(13, n + 200):
        x[t] = e[t] + sum(a * x[t - k] for k, a in enumerate(ar, 1)) + sum(b * e[t - k] for k, b in enumerate(ma, 1))
        x[t] += seasonal * x[t - 12]
    return 50 + 5 * x[200:]


def table(spark, series):
    rows = [(k, dt.date(1990 + i // 12, i % 12 + 1, 1), float(v)) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "series_key string, month date, y double")


def plain_fit(x, wide, constant):
    """Both rounds of least squares by numpy: shocks, and the best order with its AICc and coefficients."""
    longs = arma.LONG_WIDE if wide else arma.LONG_NARROW
    design = np.array([[1.0, *(x[t - k] for k in longs)] for t in range(longs[-1], len(x))])
    beta = np.linalg.lstsq(design, x[longs[-1] :], rcond=None)[0]
    e = np.concatenate([np.zeros(longs[-1]), x[longs[-1] :] - design @ beta])
    first = arma.FIRST_WIDE if wide else arma.FIRST_NARROW
    best = None
    for i, order in enumerate(arma.ORDERS):
        if not wide and order[2] + order[3]:
            continue
        mask = np.array(arma.mask_of(order), bool)
        mask[0] = constant
        row = lambda t: np.array([1.0, *(x[t - k] if wide or k < 12 else 0.0 for k in arma.LAGS), *(e[t - k] if wide or k < 12 else 0.0 for k in arma.LAGS)])
        rows = np.array([row(t)[mask] for t in range(first, len(x))]).reshape(len(x) - first, -1)
        y, full = x[first:], np.zeros(7)
        if rows.shape[1]:
            full[mask] = np.linalg.lstsq(rows, y, rcond=None)[0]
            sse = ((y - rows @ full[mask]) ** 2).sum()
        else:
            sse = (y**2).sum()
        k, n = mask.sum() + 1, len(y)
        if n - k - 1 <= 0 or not (abs(full[1]) + full[2] < 1 and full[2] > -1 and abs(full[3]) < 1):
            continue
        aicc = n * np.log(sse / n) + 2 * k + 2 * k * (k + 1) / (n - k - 1)
        if best is None or aicc < best[0]:
            best = (aicc, i, full)
    return e, best


def test_both_regressions_are_those_of_least_squares(spark):
    rng = np.random.default_rng(3)
    series = {
        "long": simulated(rng, 120, (0.5, -0.3), (0.4,)), "seasonal": simulated(rng, 90, (), (), 0.5),
        "walk": np.cumsum(rng.normal(size=70)), "short": simulated(rng, 18, (0.6,)), "yearly": 10 * np.sin(np.arange(72) * np.pi / 6) + rng.normal(size=72),
    }
    rows = arma.arma_fit(windows(table(spark, series))).select("series_key", "_arma.*").collect()
    assert {r["series_key"] for r in rows} == series.keys()
    for r in rows:
        y = series[r["series_key"]]
        z = y[12:] - y[:-12] if r["sd"] else y
        u = np.diff(z) if r["d"] else z
        x = u / np.sqrt((u**2).mean())
        assert np.allclose(r["x"], x)
        e, (aicc, order, beta) = plain_fit(x, len(x) >= arma.WIDE, r["d"] + r["sd"] <= 1)
        assert np.allclose(r["e"], e, atol=1e-8)
        assert tuple(r["order"]) == arma.ORDERS[order]
        assert r["aicc"] == pytest.approx(aicc, abs=1e-6) and np.allclose(r["beta"], beta, atol=1e-7)
    assert {r["series_key"]: r["sd"] for r in rows}["yearly"] == 1


def test_planted_orders_are_found(spark):
    rng = np.random.default_rng(8)
    planted = {
        "ar2": lambda: simulated(rng, 300, (0.5, -0.5)), "ma1": lambda: simulated(rng, 300, (), (0.8,)),
        "sar": lambda: simulated(rng, 300, (), (), 0.6), "noise": lambda: simulated(rng, 300), "walk": lambda: np.cumsum(rng.normal(size=300)),
    }
    series = {f"{name} {i}": make() for name, make in planted.items() for i in range(8)}
    got = {r["series_key"]: r for r in arma.arma_orders(table(spark, series)).collect()}
    holds = {
        "ar2": lambda r: r["d"] == 0 and r["p"] == 2, "ma1": lambda r: r["d"] == 0 and r["q"] >= 1 and r["p"] < 2,
        "sar": lambda r: r["sp"] + r["sd"] >= 1, "noise": lambda r: r["p"] + r["q"] + r["sp"] + r["sq"] <= 1 and r["d"] == 0,
        "walk": lambda r: r["d"] == 1,
    }
    for name, right in holds.items():
        found = sum(right(got[f"{name} {i}"]) for i in range(8))
        assert found >= 6, (name, found)


def test_forecasts_follow_the_model(spark):
    rng = np.random.default_rng(5)
    year = 20 * np.sin(np.arange(96) * np.pi / 6)
    series = {"yearly": 100 + year + rng.normal(0, 0.5, 96), "line": 3.0 * np.arange(60) + rng.normal(0, 0.1, 60), "flat": np.full(40, 7.0),
              "tiny": np.array([1.0, 2.0, 3.0])}
    df = table(spark, series)
    got = {}
    for r in arma.forecast_arma(df, 12).orderBy("h").collect():
        got.setdefault(r["series_key"], []).append(r["yhat"])
    assert np.allclose(got["yearly"], 100 + year[:12], atol=3)
    assert np.allclose(got["line"], 3.0 * np.arange(60, 72), atol=3)
    assert "tiny" not in got
    assert df.filter(F.col("series_key") == "x").count() == 0
    assert arma.forecast_arma(df.filter(F.lit(False))).count() == 0

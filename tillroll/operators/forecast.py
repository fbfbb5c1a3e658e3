"""Forecast models over a panel, their scores and the choice between them.

Every statistical model is a column expression from the value array of a
series to its forecasts, so one shuffle by series key serves any number of
models and series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.arrays import (
    array_mean,
    array_sum,
    last_of,
    let,
    steps,
)
from tillroll.functions.columns import ratio
from tillroll.functions.probability import student_t90
from tillroll.operators.series import FEATURES, SEASON, arrays, ts_features
from tillroll.session import pinned

BASELINES = ("Mean", "Naive", "Drift", "Seasonal Naive", "MA(3)", "MA(6)")
CLOSED = (*BASELINES, "TSLM")
FOLDED = ("ETS", "AR")
STATISTICAL = (*CLOSED, *FOLDED, "Harmonic")
BOOSTED = {"GBT depthwise": (4, 1), "GBT small": (3, 20)}
HARMONICS, RIDGE = 2, 0.1

# Candidate smoothing weights for level, trend and season.
LEVEL_GRID = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
TREND_GRID = (0.05, 0.1, 0.2)
SEASON_GRID = (0.05, 0.1, 0.2)
TINY = 1e-12
Z80 = 1.2815515655446004


def _ys() -> Column:
    """The values of a series in time order."""
    return F.col("ys")


def _n() -> Column:
    return F.size("ys")


def windows(series: DataFrame) -> DataFrame:
    """One row per series: values in time order and the last month.

    The rows are pinned, so that fits which look at them more than once never
    go back to what the panel was made of.
    """
    return pinned(
        arrays(series).select("series_key", F.element_at("months", -1).alias("last_month"), "ys")
    )


def _season_fit(w: DataFrame) -> DataFrame:
    """Adds season means of value and position, and the common slope.

    Trend plus monthly dummies by least squares is a regression of the values
    on the positions, both taken as deviations from their season's mean.
    """
    seasons = F.sequence(F.lit(0), F.lit(SEASON - 1))
    value = F.transform(
        seasons, lambda s: array_mean(F.filter(_ys(), lambda y, i: i % SEASON == s))
    )
    # Positions s, s + 12, ... average to s + 6 (count - 1).
    place = F.transform(seasons, lambda s: s + 6.0 * (F.ceil((_n() - s) / F.lit(SEASON)) - 1))
    w = w.withColumns({"_sy": value, "_st": place})
    off = lambda i: i - F.get("_st", i % SEASON)
    num = array_sum(F.transform(_ys(), lambda y, i: off(i) * (y - F.get("_sy", i % SEASON))))
    den = array_sum(F.transform(_ys(), lambda y, i: off(i) * off(i)))
    return w.withColumn("_den", den).withColumn("_slope", F.when(F.col("_den") > 0, num / F.col("_den")))


def _tslm_at(t: Column) -> Column:
    return F.get("_sy", t % SEASON) + F.col("_slope") * (t - F.get("_st", t % SEASON))


def _smoothing_grid() -> Column:
    """Candidates: simple, with trend, and with trend and season."""
    rows = [("simple", a, 0.0, 0.0, 3) for a in LEVEL_GRID]
    rows += [("trend", a, b, 0.0, 5) for a in LEVEL_GRID for b in TREND_GRID]
    rows += [
        ("season", a, b, g, 17) for a in LEVEL_GRID for b in TREND_GRID for g in SEASON_GRID
    ]
    return F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"), F.lit(a).alias("a"), F.lit(b).alias("b"),
                F.lit(g).alias("g"), F.lit(k).alias("k"),
            )
            for kind, a, b, g, k in rows
        ]
    )


def _smoothing_step(st: Column, y: Column, level: Column, trend: Column, season: Column) -> Column:
    """The state after one more value; its squared one-step error is added up."""
    now = F.get(st["s"], F.lit(0))
    return let(
        y - (st["l"] + st["b"] + now),
        lambda e: F.struct(
            (st["l"] + st["b"] + level * e).alias("l"),
            (st["b"] + trend * e).alias("b"),
            F.concat(F.slice(st["s"], 2, SEASON - 1), F.array(now + season * e)).alias("s"),
            (st["sse"] + e * e).alias("sse"),
        ),
    )


def _smoothing_fits() -> Column:
    """One-step forecasts of the chosen smoothing model over the values it was fitted on."""
    e = F.col("_ets")
    begin = F.struct(e["start"].alias("st"), F.array().cast("array<double>").alias("fits"))

    def move(acc: Column, y: Column) -> Column:
        st = acc["st"]
        return F.struct(
            _smoothing_step(st, y, e["wa"], e["wb"], e["wg"]).alias("st"),
            F.concat(acc["fits"], F.array(st["l"] + st["b"] + F.get(st["s"], F.lit(0)))).alias("fits"),
        )

    return F.aggregate(_ys(), begin, move)["fits"]


def _smoothing_fit(w: DataFrame) -> DataFrame:
    """Adds the candidate with the lowest AIC and its final state.

    One additive fold covers all kinds: the parts a kind lacks start at 0 and
    have weight 0.
    """
    first = F.get(_ys(), F.lit(0))
    slope = F.coalesce(F.try_divide(F.get(_ys(), _n() - 1) - first, _n() - 1), F.lit(0.0))
    yearly = array_mean(
        F.transform(
            F.slice(_ys(), F.lit(SEASON + 1), F.greatest(_n() - SEASON, F.lit(0))),
            lambda y, i: (y - F.get(_ys(), i)) / SEASON,
        )
    )
    w = w.withColumns({"_slope0": slope, "_yearly": yearly})
    w = w.withColumn(
        "_level0",
        array_mean(F.slice(_ys(), 1, SEASON)) - F.col("_yearly") * ((SEASON + 1) / 2),
    )
    w = w.withColumn(
        "_season0",
        F.transform(
            F.slice(_ys(), 1, SEASON), lambda y, i: y - F.col("_level0") - F.col("_yearly") * (i + 1)
        ),
    )
    none = F.array_repeat(F.lit(0.0), SEASON)

    def start(c: Column) -> Column:
        seasonal = c["kind"] == "season"
        level = F.when(seasonal, F.col("_level0")).when(
            c["kind"] == "trend", first - F.col("_slope0")
        ).otherwise(first)
        trend = F.when(seasonal, F.col("_yearly")).when(
            c["kind"] == "trend", F.col("_slope0")
        ).otherwise(0.0)
        return F.struct(
            level.alias("l"), trend.alias("b"),
            F.when(seasonal, F.col("_season0")).otherwise(none).alias("s"),
            F.lit(0.0).alias("sse"),
        )

    def step(c: Column):
        return lambda st, y: _smoothing_step(st, y, c["a"], c["b"], c["g"])

    def scored(c: Column, i: Column) -> Column:
        end = F.aggregate(_ys(), start(c), step(c))
        return let(
            end,
            lambda st: F.struct(
                (_n() * F.log(F.greatest(st["sse"] / _n(), F.lit(TINY))) + 2 * c["k"]).alias("aic"),
                i.alias("i"), c["kind"].alias("kind"), st["l"].alias("l"), st["b"].alias("b"),
                st["s"].alias("s"), st["sse"].alias("sse"), c["a"].alias("wa"), c["b"].alias("wb"),
                c["g"].alias("wg"), c["k"].alias("k"), start(c).alias("start"),
            ),
        )

    usable = F.filter(_smoothing_grid(), lambda c: (c["kind"] != "season") | (_n() > SEASON))
    return w.withColumn("_ets", F.array_min(F.transform(usable, scored)))


def _ar_fit(w: DataFrame) -> DataFrame:
    """Adds the autoregression with the lowest AIC per observation.

    Candidates are white noise and order 1 on the values, their differences
    and their differences over a season.
    """
    def differenced(d: int) -> Column:
        return F.transform(
            F.slice(_ys(), F.lit(d + 1), F.greatest(_n() - d, F.lit(0))), lambda y, i: y - F.get(_ys(), i)
        )

    w = w.withColumns({"_x0": _ys(), "_x1": differenced(1), "_x12": differenced(SEASON)})

    def candidates(d: int) -> list[Column]:
        x = F.col(f"_x{d}")
        m = F.size(x) - 1
        before, after = F.slice(x, F.lit(1), F.greatest(m, F.lit(0))), F.slice(
            x, F.lit(2), F.greatest(m, F.lit(0))
        )
        mb, ma = array_mean(before), array_mean(after)
        pairs = F.arrays_zip(before.alias("u"), after.alias("v"))
        sxx = let(mb, lambda u0: array_sum(F.transform(before, lambda u: (u - u0) * (u - u0))))
        syy = let(ma, lambda v0: array_sum(F.transform(after, lambda v: (v - v0) * (v - v0))))
        sxy = let(
            F.struct(mb.alias("u"), ma.alias("v")),
            lambda c: array_sum(
                F.transform(pairs, lambda p: (p["u"] - c["u"]) * (p["v"] - c["v"]))
            ),
        )
        sums = F.struct(
            sxx.alias("sxx"), syy.alias("syy"), sxy.alias("sxy"), mb.alias("mb"), ma.alias("ma")
        )

        def fit(phi: Column, const: Column, sse: Column, k: int) -> Column:
            return F.struct(
                (F.log(F.greatest(sse / m, F.lit(TINY))) + F.lit(2.0 * k) / m).alias("aic"),
                F.lit(d).alias("d"), phi.alias("phi"), const.alias("c"),
                F.get(x, m).alias("x"), sse.alias("sse"), F.nullif(m - (k - 1), F.lit(0)).alias("free"),
            )

        def both(s: Column) -> Column:
            phi = F.try_divide(s["sxy"], s["sxx"])
            order_1 = fit(phi, s["ma"] - phi * s["mb"], s["syy"] - phi * s["sxy"], 3)
            noise = fit(F.lit(0.0), s["ma"], s["syy"], 2)
            # Only the stationary range of phi is admitted.
            return F.array(noise, F.when(F.abs(phi) < 1, order_1))

        return [F.when(m >= 4, let(sums, both))]

    every = F.concat(
        *[F.coalesce(c, F.array()) for d in (0, 1, SEASON) for c in candidates(d)]
    )
    return w.withColumn("_ar", F.array_min(F.filter(every, lambda c: c.isNotNull())))


def _ar_values(h: int) -> Column:
    ar = F.col("_ar")
    power = lambda k: F.pow(ar["phi"], k)
    x = F.transform(
        steps(h),
        lambda k: ar["x"] * power(k) + ar["c"] * (1 - power(k)) / (1 - ar["phi"]),
    )
    return let(
        x,
        lambda xs: F.when(ar["d"] == 0, xs)
        .when(
            ar["d"] == 1,
            F.transform(steps(h), lambda k: F.get(_ys(), _n() - 1) + array_sum(F.slice(xs, F.lit(1), k))),
        )
        .otherwise(
            F.transform(
                steps(h),
                lambda k: F.get(_ys(), _n() - SEASON + (k - 1) % SEASON)
                + array_sum(F.filter(xs, lambda v, j: (j < k) & ((k - 1 - j) % SEASON == 0))),
            )
        ),
    )


def forecast_values(model: str, h: int) -> Column:
    """The ``h`` forecasts of one model as an array over a ``prepared`` row."""
    last, first = F.get(_ys(), _n() - 1), F.get(_ys(), F.lit(0))
    if model == "Mean":
        return F.array_repeat(array_mean(_ys()), h)
    if model == "Naive":
        return F.array_repeat(last, h)
    if model == "Drift":
        return F.transform(steps(h), lambda k: last + k * F.try_divide(last - first, _n() - 1))
    if model == "Seasonal Naive":
        return F.transform(steps(h), lambda k: F.get(_ys(), _n() - SEASON + (k - 1) % SEASON))
    if model in ("MA(3)", "MA(6)"):
        return F.array_repeat(array_mean(last_of(_ys(), int(model[3]))), h)
    if model == "TSLM":
        return F.transform(steps(h), lambda k: _tslm_at(_n() - 1 + k))
    if model == "ETS":
        e = F.col("_ets")
        return F.transform(
            steps(h), lambda k: e["l"] + k * e["b"] + F.get(e["s"], (k - 1) % SEASON)
        )
    if model == "AR":
        return _ar_values(h)
    if model == "Harmonic":
        return F.transform(steps(h), lambda k: _harmonic_at(_n() + k))
    raise ValueError(f"unknown model: {model}")


def prepared(w: DataFrame, models: Sequence[str]) -> DataFrame:
    """Adds the fits the chosen models share."""
    if "TSLM" in models:
        w = _season_fit(w)
    if "ETS" in models:
        w = _smoothing_fit(w)
    if "AR" in models:
        w = _ar_fit(w)
    if "Harmonic" in models:
        w = _harmonic_fit(w)
    return w


def _long(w: DataFrame, per_model: dict[str, Column], name: str) -> DataFrame:
    """``(series_key, last_month, model, h, name)`` from one array per model."""
    entries = F.array(
        *[F.struct(F.lit(m).alias("model"), v.alias("v")) for m, v in per_model.items()]
    )
    return w.select("series_key", "last_month", _n().alias("_n"), F.explode(entries).alias("_e")).select(
        "series_key", "last_month", "_n", F.col("_e.model").alias("model"),
        F.posexplode("_e.v").alias("_k", name),
    )


def forecast(series: DataFrame, models: Sequence[str] = CLOSED, h: int = 6) -> DataFrame:
    """``(series_key, model, month, h, yhat)`` for the ``h`` months after each series."""
    w = prepared(windows(series), models)
    long = _long(w, {m: forecast_values(m, h) for m in models}, "yhat")
    return long.select(
        "series_key", "model", F.add_months("last_month", F.col("_k") + 1).alias("month"),
        (F.col("_k") + 1).alias("h"), "yhat",
    )


def _fitted(model: str) -> Column:
    lag = lambda k: F.transform(_ys(), lambda y, i: F.get(_ys(), i - k))
    if model == "Mean":
        return let(array_mean(_ys()), lambda m: F.transform(_ys(), lambda y: m))
    if model == "Naive":
        return lag(1)
    if model == "Drift":
        slope = F.try_divide(F.get(_ys(), _n() - 1) - F.get(_ys(), F.lit(0)), _n() - 1)
        return let(slope, lambda b: F.transform(_ys(), lambda y, i: F.get(_ys(), i - 1) + b))
    if model == "Seasonal Naive":
        return lag(SEASON)
    if model in ("MA(3)", "MA(6)"):
        # The rolling mean is only a forecast rule; it passes its input through.
        return _ys()
    if model == "TSLM":
        return F.transform(_ys(), lambda y, i: _tslm_at(i))
    if model == "ETS":
        return _smoothing_fits()
    if model == "AR":
        ar = F.col("_ar")
        back = lambda i, k: F.get(_ys(), i - k)
        change = lambda i: ar["c"] + ar["phi"] * (back(i, 1) - back(i, 1 + ar["d"]))
        plain = F.transform(_ys(), lambda y, i: ar["c"] + ar["phi"] * back(i, 1))
        return F.when(ar["d"] == 0, plain).otherwise(F.transform(_ys(), lambda y, i: back(i, ar["d"]) + change(i)))
    if model == "Harmonic":
        return F.transform(_ys(), lambda y, i: _harmonic_at(i + 1))
    raise ValueError(f"no fitted values for {model}")


def residuals(series: DataFrame, models: Sequence[str] = CLOSED) -> DataFrame:
    """``(series_key, model, month, y, fitted, residual)`` over the training months."""
    w = prepared(windows(series), models)
    both = {
        m: F.arrays_zip(_ys().alias("y"), _fitted(m).alias("fitted")) for m in models
    }
    long = _long(w, both, "_v")
    passes = F.col("model").isin("MA(3)", "MA(6)")
    return long.select(
        "series_key", "model", F.add_months("last_month", F.col("_k") + 1 - F.col("_n")).alias("month"),
        F.col("_v.y").alias("y"), F.col("_v.fitted").alias("fitted"),
        F.when(~passes, F.col("_v.y") - F.col("_v.fitted")).alias("residual"),
    )


# --- scores and choice ---------------------------------------------------------


def accuracy(forecasts: DataFrame, test: DataFrame, train: DataFrame) -> DataFrame:
    """MAE, RMSE, MAPE and MASE per series and model over the test months.

    Months with an actual of 0 have no percentage error; ``zero_months`` counts
    them. The MASE scale is the mean absolute 12-month change in training and
    NULL for a shorter or unchanging history.
    """
    change = F.abs(F.col("y") - F.lag("y", SEASON).over(Window.partitionBy("series_key").orderBy("month")))
    scale = (
        train.withColumn("_c", change)
        .groupBy("series_key")
        .agg(F.avg("_c").alias("_scale"))
        .withColumn("_scale", F.when(F.col("_scale") > 0, F.col("_scale")))
    )
    error = F.col("y") - F.col("yhat")
    return (
        forecasts.join(test, ["series_key", "month"])
        .groupBy("series_key", "model")
        .agg(
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(F.when(F.col("y") != 0, 100 * F.abs(error / F.nullif(F.col("y"), F.lit(0.0))))).alias("mape"),
            F.count(F.when(F.col("y") == 0, 1)).alias("zero_months"),
        )
        .join(scale, "series_key", "left")
        .withColumn("mase", ratio(F.col("mae"), F.col("_scale")))
        .drop("_scale")
    )


def best_model(scores: DataFrame) -> DataFrame:
    """The model with the lowest RMSE per series; ties go to the first name."""
    usable = scores.filter(F.col("rmse").isNotNull())
    return (
        usable.groupBy("series_key")
        .agg(F.min(F.struct("rmse", "model")).alias("_b"))
        .select("series_key", F.col("_b.model").alias("model"), F.col("_b.rmse").alias("rmse"))
    )


def compare(forecasts: DataFrame, actual: DataFrame) -> DataFrame:
    """Actual and forecast values as one long table ``(series_key, month, source, value)``."""
    return actual.select(
        "series_key", "month", F.lit("actual").alias("source"), F.col("y").alias("value")
    ).unionByName(
        forecasts.select(
            "series_key", "month", F.col("model").alias("source"), F.col("yhat").alias("value")
        )
    )


def future(series: DataFrame, best: DataFrame, models: Sequence[str] = CLOSED, h: int = 6) -> DataFrame:
    """Each series' best model on its full history, ``h`` months ahead.

    A model is fitted to the series that chose it and to no other. Series whose
    best model is not among ``models`` are left to ``future_boosted``.
    """
    chosen = pinned(best.select("series_key", "model"))
    names = {r["model"] for r in chosen.select("model").distinct().collect()}
    w = windows(series.join(chosen.select("series_key"), "series_key", "left_semi")).join(chosen, "series_key")
    out = None
    for m in [m for m in models if m in names]:
        ahead = prepared(w.filter(F.col("model") == m), [m]).select(
            "series_key", "model", "last_month", F.posexplode(forecast_values(m, h)).alias("_k", "yhat")
        )
        out = ahead if out is None else out.unionByName(ahead)
    if out is None:
        out = w.limit(0).select("series_key", "model", "last_month", F.lit(0).alias("_k"), F.lit(0.0).alias("yhat"))
    return out.select("series_key", "model", F.add_months("last_month", F.col("_k") + 1).alias("month"), "yhat")


def _tslm_leverage(t: Column) -> Column:
    """Leverage of position ``t`` in the regression on trend and season."""
    season = t % SEASON
    count = F.ceil((_n() - season) / F.lit(SEASON))
    off = t - F.get("_st", season)
    return 1 / F.nullif(count, F.lit(0)) + off * off / F.nullif(F.col("_den"), F.lit(0.0))


def _ar_weight(ar: Column, j: Column) -> Column:
    """How much of a shock ``j`` months ago is left, ``j`` from 1 on."""
    power = F.pow(ar["phi"], j)
    every = F.transform(F.sequence(F.lit(0), F.floor(j / SEASON).cast("int")), lambda i: F.pow(ar["phi"], j - SEASON * i))
    return (
        F.when(ar["d"] == 0, power)
        .when(ar["d"] == 1, (1 - power * ar["phi"]) / (1 - ar["phi"]))
        .otherwise(array_sum(every))
    )


def _spread_over(s: Column, weight, h: int) -> Column:
    """80% half-widths for ``h`` months from the spread of a month and the weights of past shocks."""
    def width(k: Column) -> Column:
        past = F.filter(steps(h), lambda j: j < k)
        return Z80 * s * F.sqrt(1 + F.coalesce(array_sum(F.transform(past, lambda j: weight(j) * weight(j))), F.lit(0.0)))

    return F.transform(steps(h), width)


def intervals(series: DataFrame, models: Sequence[str] = CLOSED, h: int = 6) -> DataFrame:
    """Forecasts with 80% bounds; NULL bounds for models that have none.

    Mean, naive, drift, seasonal naive, smoothing and autoregression grow with
    the horizon in closed form. The regression has the prediction interval of
    least squares: Student's t, residual spread and the leverage of the month
    ahead. Moving means and the penalised harmonic regression have none.
    """
    w = prepared(windows(series), models)

    def residual(m: str) -> Column:
        return F.filter(
            F.zip_with(_ys(), _fitted(m), lambda y, f: y - f), lambda e: e.isNotNull()
        )

    # Parameters plus start-up months that leave no residual.
    lost = {"Mean": 1, "Naive": 1, "Drift": 2, "Seasonal Naive": SEASON, "TSLM": SEASON + 1}

    def sigma(m: str) -> Column:
        sse = array_sum(F.transform(residual(m), lambda e: e * e))
        return F.sqrt(F.when(_n() > lost[m], sse / F.nullif(_n() - lost[m], F.lit(0))))

    growth = {
        "Mean": lambda k: F.sqrt(1 + F.lit(1.0) / _n()),
        "Naive": lambda k: F.sqrt(k.cast("double")),
        "Drift": lambda k: F.sqrt(k * (1 + F.try_divide(k.cast("double"), _n() - 1))),
        "Seasonal Naive": lambda k: F.sqrt(F.floor((k - 1) / F.lit(SEASON)) + 1.0),
    }

    def half_width(m: str) -> Column:
        if m in growth:
            return let(sigma(m), lambda s: F.transform(steps(h), lambda k: Z80 * s * growth[m](k)))
        if m == "TSLM":
            quantile = student_t90(_n() - lost[m])
            return let(sigma(m), lambda s: F.transform(steps(h), lambda k: quantile * s * F.sqrt(1 + _tslm_leverage(_n() - 1 + k))))
        if m == "ETS":
            e = F.col("_ets")
            s = F.sqrt(F.when(_n() > e["k"], e["sse"] / F.nullif(_n() - e["k"], F.lit(0))))
            weight = lambda j: e["wa"] + j * e["wb"] + F.when(j % SEASON == 0, e["wg"]).otherwise(0.0)
            return _spread_over(s, weight, h)
        if m == "AR":
            ar = F.col("_ar")
            s = F.sqrt(F.when(ar["free"] > 0, ar["sse"] / ar["free"]))
            return _spread_over(s, lambda j: _ar_weight(ar, j), h)
        return F.array_repeat(F.lit(None).cast("double"), h)

    rows = {}
    for m in models:
        wide = half_width(m)
        rows[m] = F.arrays_zip(
            forecast_values(m, h).alias("yhat"), F.transform(wide, lambda v: -v).alias("low"), wide.alias("high")
        )
    long = _long(w, rows, "_v")
    return long.select(
        "series_key", "model", F.add_months("last_month", F.col("_k") + 1).alias("month"),
        F.col("_v.yhat").alias("yhat"),
        (F.col("_v.yhat") + F.col("_v.low")).alias("lo80"),
        (F.col("_v.yhat") + F.col("_v.high")).alias("hi80"),
    )


# --- harmonic regression ---------------------------------------------------------


def _harmonic_terms(t: Column) -> Column:
    """Trend and yearly sine and cosine terms at the 1-based position ``t``."""
    terms = [t / _n()]
    for k in range(1, HARMONICS + 1):
        angle = t * (2 * np.pi * k / SEASON)
        terms += [F.sin(angle), F.cos(angle)]
    return F.array(*terms)


def harmonic_inverse(n: int) -> tuple[list[float], list[list[float]]]:
    """Means of the terms over ``n`` months and the inverse of their penalised cross products."""
    t = np.arange(1, n + 1, dtype=float)
    columns = [t / n]
    for k in range(1, HARMONICS + 1):
        columns += [np.sin(2 * np.pi * k * t / SEASON), np.cos(2 * np.pi * k * t / SEASON)]
    x = np.column_stack(columns)
    centre = x.mean(axis=0)
    xc = x - centre
    return centre.tolist(), np.linalg.inv(xc.T @ xc + RIDGE * np.eye(x.shape[1])).tolist()


def _harmonic_fit(w: DataFrame) -> DataFrame:
    """Adds the mean, the centres and the coefficients of a ridge regression on trend and season.

    The design depends on the length of a series alone: shifting the start
    month only rotates each sine-cosine pair, which the penalty does not
    notice. One small inverse per length is broadcast; there are no more
    lengths than calendar months.
    """
    lengths = [r[0] for r in w.select(_n().alias("n")).distinct().collect()]
    table = [(n, *harmonic_inverse(n)) for n in lengths]
    inverses = w.sparkSession.createDataFrame(table, "_length int, _centre array<double>, _inverse array<array<double>>")
    w = w.join(F.broadcast(inverses), _n() == F.col("_length")).withColumn("_mean", array_mean(_ys()))
    terms = F.transform(_ys(), lambda y, i: F.struct(_harmonic_terms(i + 1).alias("x"), (y - F.col("_mean")).alias("y")))
    w = w.withColumn("_terms", terms)
    places = F.sequence(F.lit(0), F.lit(2 * HARMONICS))
    crossed = F.transform(
        places,
        lambda j: array_sum(F.transform("_terms", lambda r: (F.get(r["x"], j) - F.get("_centre", j)) * r["y"])),
    )
    w = w.withColumn("_crossed", crossed)
    slopes = F.transform("_inverse", lambda row: array_sum(F.zip_with(row, "_crossed", lambda a, b: a * b)))
    return w.withColumn("_slopes", slopes).drop("_terms", "_crossed", "_inverse", "_length")


def _harmonic_at(t: Column) -> Column:
    off = F.zip_with(_harmonic_terms(t), "_centre", lambda x, c: x - c)
    return F.col("_mean") + array_sum(F.zip_with(off, "_slopes", lambda x, b: x * b))


def forecast_harmonic(series: DataFrame, h: int = 6) -> DataFrame:
    """In-sample fits (``h`` <= 0) and forecasts of the harmonic regression."""
    w = _harmonic_fit(windows(series))
    both = F.concat(_fitted("Harmonic"), forecast_values("Harmonic", h))
    return _long(w, {"Harmonic": both}, "yhat").select(
        "series_key", "model",
        F.add_months("last_month", F.col("_k") + 1 - F.col("_n")).alias("month"),
        (F.col("_k") + 1 - F.col("_n")).alias("h"), "yhat",
    )


# --- boosted trees ---------------------------------------------------------------

SCALED = ("lag_1", "lag_3", "lag_6", "lag_12", "ma_3", "ma_6")


def boosted_features(parted: DataFrame, leak_free: bool = True) -> DataFrame:
    """Feature rows in units of the series' training mean (1 if it is not positive), with their part."""
    scale = (
        parted.filter(F.col("part") == "train")
        .groupBy("series_key")
        .agg(F.avg("y").alias("_m"))
        .select("series_key", F.when(F.col("_m") > 0, F.col("_m")).otherwise(1.0).alias("scale"))
    )
    rows = ts_features(parted.select("series_key", "month", "y", "part"), leak_free)
    rows = rows.join(scale, "series_key")
    return rows.withColumn("target", F.col("y") / F.col("scale")).withColumns(
        {c: F.col(c) / F.col("scale") for c in SCALED}
    )


def fit_boosted(
    rows: DataFrame, depth: int = 4, min_leaf: int = 1, rounds: int = 100, rate: float = 0.1,
    seed: int = 42,
):
    """One model for the whole panel, fitted on the training rows.

    The rows are read once per boosting round, so they are pinned first, in as
    few partitions as their size asks for.
    """
    train = pinned(
        _vector(rows.filter(F.col("part") == "train")).select("features", "target")
    )
    return GBTRegressor(
        featuresCol="features", labelCol="target", maxDepth=depth, maxIter=rounds,
        stepSize=rate, minInstancesPerNode=min_leaf, seed=seed,
    ).fit(train)


def _vector(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def predict_rows(model, rows: DataFrame, name: str) -> DataFrame:
    """One-step forecasts for rows whose lags are already known."""
    return model.transform(_vector(rows)).select(
        "series_key", F.lit(name).alias("model"), "month",
        (F.col("prediction") * F.col("scale")).alias("yhat"),
    )


def predict_recursive(model, history: DataFrame, scale: DataFrame, name: str, h: int = 6) -> DataFrame:
    """``h`` months ahead, each forecast feeding the next month's features.

    The state of a series is one row with its value array, so a step is a
    projection and the model; nothing is shuffled between steps.
    """
    state = (
        windows(history)
        .filter(_n() >= SEASON)
        .join(scale.select("series_key", "scale"), "series_key")
        .withColumn("ys", F.transform("ys", lambda y: y / F.col("scale")))
    )
    for _ in range(h):
        month = F.add_months("last_month", 1)
        back = lambda k: F.get(_ys(), _n() - k)
        step = state.withColumns(
            {
                "year": F.year(month),
                "month_num": F.month(month),
                "quarter_num": F.quarter(month),
                "trend": _n() + 1,
                **{f"lag_{k}": back(k) for k in (1, 3, 6, 12)},
                **{f"ma_{k}": array_mean(last_of(_ys(), k)) for k in (3, 6)},
            }
        )
        state = model.transform(_vector(step)).select(
            "series_key", "scale", F.add_months("last_month", 1).alias("last_month"),
            F.concat("ys", F.array("prediction")).alias("ys"),
        )
    tail = F.transform(last_of(_ys(), h), lambda v: v * F.col("scale"))
    return state.select("series_key", "last_month", F.posexplode(tail).alias("_k", "yhat")).select(
        "series_key", F.lit(name).alias("model"),
        F.add_months("last_month", F.col("_k") + 1 - h).alias("month"),
        (F.col("_k") + 1).alias("h"), "yhat",
    )


def forecast_boosted(
    parted: DataFrame, name: str, depth: int = 4, min_leaf: int = 1, rounds: int = 100,
    h: int = 6, leak_free: bool = True,
) -> DataFrame:
    """Boosted trees over the panel for the test months.

    The default uses nothing after the last training month. With
    ``leak_free=False`` the moving means include the target month and the test
    rows use the real lags, which flatters the score.
    """
    rows = boosted_features(parted, leak_free)
    model = fit_boosted(rows, depth, min_leaf, rounds)
    if not leak_free:
        return predict_rows(model, rows.filter(F.col("part") == "test"), name)
    history = parted.filter(F.col("part").isin("skip", "train")).select("series_key", "month", "y")
    scale = rows.select("series_key", "scale").distinct()
    return predict_recursive(model, history, scale, name, h).drop("h")


@dataclass(frozen=True)
class BoostedModels:
    """Both boosted models of a panel, with the rows they learned from and the scale of each series."""

    rows: DataFrame
    models: dict[str, GBTRegressionModel]

    def scale(self) -> DataFrame:
        return self.rows.select("series_key", "scale").distinct()


def fit_all_boosted(parted: DataFrame, leak_free: bool = True, rounds: int = 100) -> BoostedModels:
    rows = pinned(boosted_features(parted, leak_free))
    return BoostedModels(rows, {name: fit_boosted(rows, *BOOSTED[name], rounds) for name in BOOSTED})


def boosted_forecasts(parted: DataFrame, fitted: BoostedModels, h: int = 6) -> DataFrame:
    """Test months of all boosted models, each forecast feeding the next month's features."""
    history = parted.filter(F.col("part").isin("skip", "train")).select("series_key", "month", "y")
    out = [predict_recursive(model, history, fitted.scale(), name, h).drop("h") for name, model in fitted.models.items()]
    return reduce(DataFrame.unionByName, out)


def boosted_residuals(fitted: BoostedModels) -> DataFrame:
    """``(series_key, model, month, y, fitted, residual)`` over the training months whose features are known."""
    learned = fitted.rows.filter(F.col("part") == "train")
    told = [predict_rows(model, learned, name) for name, model in fitted.models.items()]
    both = reduce(DataFrame.unionByName, told).join(learned.select("series_key", "month", "y"), ["series_key", "month"])
    return both.select(
        "series_key", "model", "month", "y", F.col("yhat").alias("fitted"), (F.col("y") - F.col("yhat")).alias("residual")
    )


@dataclass(frozen=True)
class AllModels:
    """What every model, statistical and boosted, says about a panel that ``split`` has parted."""

    forecasts: DataFrame
    scores: DataFrame
    best: DataFrame
    residuals: DataFrame
    future: DataFrame


def all_models(parted: DataFrame, h: int = 6, rounds: int = 100) -> AllModels:
    """Forecasts of the test months, scores, choice, residuals and the chosen models' future.

    The boosted models are fitted once for the test months and, if a series
    chose one of them, once more on all months. What later steps read is
    pinned.
    """
    learn = parted.filter(F.col("part") == "train").select("series_key", "month", "y")
    hold = parted.filter(F.col("part") == "test").select("series_key", "month", "y")
    history = parted.select("series_key", "month", "y")
    names = ("series_key", "model", "month", "yhat")
    boosted = fit_all_boosted(parted, rounds=rounds)
    found = forecast(learn, STATISTICAL, h).select(*names)
    found = pinned(found.unionByName(boosted_forecasts(parted, boosted, h).select(*names)))
    scores = pinned(accuracy(found, hold, learn))
    best = pinned(best_model(scores))
    ahead = future(history, best, STATISTICAL, h)
    scored = history.join(best.select("series_key"), "series_key", "left_semi")
    for name in BOOSTED:
        if best.filter(F.col("model") == name).take(1):
            ahead = ahead.unionByName(future_boosted(scored, best, name, h, rounds))
    left = residuals(learn, STATISTICAL).unionByName(boosted_residuals(boosted))
    return AllModels(found, scores, best, left, ahead)


def future_boosted(series: DataFrame, best: DataFrame, name: str, h: int = 6, rounds: int = 100) -> DataFrame:
    """``h`` months ahead for the series whose best model is this boosted one.

    The trees are fitted anew on the full histories of all series, since one
    model serves the panel; only the chosen series are walked forward.
    """
    depth, leaf = BOOSTED[name]
    rows = boosted_features(series.withColumn("part", F.lit("train")))
    model = fit_boosted(rows, depth, leaf, rounds)
    chosen = series.join(best.filter(F.col("model") == name).select("series_key"), "series_key", "left_semi")
    scale = rows.select("series_key", "scale").distinct()
    return predict_recursive(model, chosen, scale, name, h).select("series_key", "model", "month", "yhat")

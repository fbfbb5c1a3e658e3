"""Seasonal ARMA models by two rounds of least squares.

Differences come first: over a season where the months of the year explain
most of what trend leaves, and over a month where a unit-root test refuses a
stationary level. A long autoregression then tells the shocks, and values are
regressed on past values and past shocks; among all orders the one with the
smallest corrected AIC is kept. Every candidate solves a part of the same
normal equations, so a series is summed up once.

As in the other models, all of it is column expressions over the value array
of a series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.arrays import array_mean, array_sum, let, steps
from tillroll.operators.forecast import TINY, _long, _season_fit, _tslm_at, windows
from tillroll.operators.series import SEASON
from tillroll.session import pinned

# Share of the detrended spread that the season explains from which it is differenced, and months needed for it.
STRENGTH, SEASON_MONTHS = 0.64, 36
# Critical value of the test of a stationary level at 5%.
LEVEL_TEST = 0.463
# Differenced months from which seasonal terms are tried; lags of the long autoregression with them and without.
WIDE, LONG_WIDE, LONG_NARROW = 40, (1, 2, 3, 4, SEASON), (1, 2, 3)
# Regressors after the constant: lags of values, then of shocks. First month that has them all.
LAGS = (1, 2, SEASON)
FIRST_WIDE, FIRST_NARROW = 2 * SEASON, 5
# Orders (p, q, seasonal P, seasonal Q) in the order in which ties are broken.
ORDERS = tuple((p, q, sp, sq) for sp in (0, 1) for sq in (0, 1) for p in (0, 1, 2) for q in (0, 1, 2))
MATRIX = "array<array<double>>"


def mask_of(order: Sequence[int]) -> list[float]:
    """Which regressors an order has: the constant, three lags of values, three of shocks."""
    p, q, sp, sq = order
    return [1.0, *(float(p >= k) for k in (1, 2)), float(sp), *(float(q >= k) for k in (1, 2)), float(sq)]


def normal_equations(rows: Column) -> Column:
    """Sums of all products of two entries of the rows."""
    def sums(places: Column) -> Column:
        return F.transform(
            places,
            lambda i: F.transform(
                places,
                lambda j: F.aggregate(rows, F.lit(0.0), lambda acc, r: acc + F.get(r, i) * F.get(r, j)),
            ),
        )

    return sums(F.sequence(F.lit(0), F.size(F.get(rows, F.lit(0))) - 1)).cast(MATRIX)


def solved(equations: Column) -> Column:
    """Solution of linear equations, one per row with the right side last; NULLs where they have none."""
    def eliminate(m: Column, j: Column) -> Column:
        own = F.get(m, j)
        pivot = F.transform(own, lambda v: F.try_divide(v, F.get(own, j)))

        def rest(p: Column) -> Column:
            return F.transform(
                m, lambda row, i: F.when(i == j, p).otherwise(F.zip_with(row, p, lambda a, b: a - F.get(row, j) * b))
            )

        return let(pivot, rest).cast(MATRIX)

    done = F.aggregate(F.sequence(F.lit(0), F.size(equations) - 1), equations.cast(MATRIX), eliminate)
    return F.transform(done, lambda row: F.element_at(row, -1))


def _product(a: Column, b: Column) -> Column:
    return array_sum(F.zip_with(a, b, lambda u, v: u * v))


def _differenced(a: Column, lag: int) -> Column:
    later = F.slice(a, F.lit(lag + 1), F.greatest(F.size(a) - lag, F.lit(0)))
    return F.transform(later, lambda v, i: v - F.get(a, i))


def season_strength() -> Column:
    """Share of the spread around the trend that the months of the year explain."""
    middle = (F.size("ys") - 1) / F.lit(2.0)
    left = array_sum(F.transform("ys", lambda y, i: F.pow(y - _tslm_at(i), 2)))
    around = let(
        array_mean(F.col("ys")),
        lambda m: array_sum(F.transform("ys", lambda y, i: F.pow(y - m - F.col("_slope") * (i - middle), 2))),
    )
    return 1 - F.try_divide(left, around)


def level_statistic(z: Column) -> Column:
    """Kwiatkowski-Phillips-Schmidt-Shin statistic of a stationary level."""
    n = F.size(z)
    e = let(array_mean(z), lambda m: F.transform(z, lambda v: v - m))

    def told(e: Column) -> Column:
        upto = F.transform(e, lambda v, i: array_sum(F.slice(e, F.lit(1), i + 1)))
        lag = F.floor(3 * F.sqrt(n.cast("double")) / 13).cast("int")
        near = F.when(lag >= 1, F.sequence(F.lit(1), lag)).otherwise(F.array().cast("array<int>"))
        together = array_sum(
            F.transform(
                near,
                lambda j: (1 - j / (lag + 1)) * _product(F.slice(e, j + 1, n - j), F.slice(e, F.lit(1), n - j)),
            )
        )
        spread = (_product(e, e) + 2 * together) / n
        return F.try_divide(_product(upto, upto), spread * n * n)

    return let(e, told)


def arma_fit(w: DataFrame) -> DataFrame:
    """Adds the chosen model as ``_arma``, NULL for a series too short for any order.

    ``d`` and ``sd`` are the differences over a month and a season, ``x`` the
    differenced values in units of ``scale``, ``e`` the shocks, ``beta`` the
    coefficients in the order of ``mask_of``, ``aicc`` what it was chosen by.
    """
    w = _season_fit(w)
    n = F.size("ys")
    w = w.withColumn("_sd", ((n >= SEASON_MONTHS) & F.coalesce(season_strength() > STRENGTH, F.lit(False))).cast("int"))
    w = w.withColumn("_z", F.when(F.col("_sd") == 1, _differenced(F.col("ys"), SEASON)).otherwise(F.col("ys")))
    w = w.withColumn("_d", F.coalesce(level_statistic(F.col("_z")) > LEVEL_TEST, F.lit(False)).cast("int"))
    w = w.withColumn("_u", F.when(F.col("_d") == 1, _differenced(F.col("_z"), 1)).otherwise(F.col("_z")))
    size = F.sqrt(F.try_divide(_product(F.col("_u"), F.col("_u")), F.size("_u")))
    w = w.withColumn("_scale", F.when(size > 0, size).otherwise(1.0))
    w = w.withColumn("_x", F.transform("_u", lambda v: v / F.col("_scale")))
    x, m = F.col("_x"), F.size("_x")
    w = w.withColumn("_wide", m >= WIDE)
    longs = F.when(F.col("_wide"), F.array(*map(F.lit, LONG_WIDE))).otherwise(F.array(*map(F.lit, LONG_NARROW)))
    reach = F.when(F.col("_wide"), LONG_WIDE[-1]).otherwise(LONG_NARROW[-1])
    w = w.withColumns({"_longs": longs, "_reach": reach})

    def long_row(t: Column) -> Column:
        return F.concat(F.array(F.lit(1.0)), F.transform("_longs", lambda k: F.get(x, t - k)))

    from_reach = F.when(m > F.col("_reach"), F.sequence(F.col("_reach"), m - 1))
    rows = F.transform(from_reach, lambda t: F.concat(long_row(t), F.array(F.get(x, t))))
    w = w.withColumn("_normal", normal_equations(rows))
    w = w.withColumn("_long", solved(F.slice("_normal", F.lit(1), F.size("_normal") - 1)))
    shocks = F.transform(x, lambda v, t: F.when(t >= F.col("_reach"), v - _product(long_row(t), F.col("_long"))).otherwise(0.0))
    w = w.withColumn("_e", shocks)

    def row(t: Column) -> Column:
        seasonal = lambda a: F.when(F.col("_wide"), F.get(a, t - SEASON)).otherwise(0.0)
        e = F.col("_e")
        lags = [*(F.get(x, t - k) for k in (1, 2)), seasonal(x), *(F.get(e, t - k) for k in (1, 2)), seasonal(e)]
        return F.array(F.lit(1.0), *lags, F.get(x, t))

    first = F.when(F.col("_wide"), FIRST_WIDE).otherwise(FIRST_NARROW)
    w = w.withColumn("_first", first).withColumn("_rows", F.when(m > first, F.sequence(first, m - 1)))
    w = w.withColumn("_normal", normal_equations(F.transform("_rows", row))).withColumn("_count", F.size("_rows"))

    orders = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"), F.array(*map(F.lit, order)).alias("order"), F.array(*map(F.lit, mask_of(order))).alias("mask")
            )
            for i, order in enumerate(ORDERS)
        ]
    )
    narrow = lambda c: F.get(c["order"], F.lit(2)) + F.get(c["order"], F.lit(3)) == 0
    usable = F.filter(orders, lambda c: F.col("_wide") | narrow(c))

    def masked(mask: Column) -> Column:
        """The equations of one candidate: those of absent regressors say that they are 0."""
        return F.transform(
            F.slice("_normal", F.lit(1), F.lit(2 * len(LAGS) + 1)),
            lambda r, i: F.transform(
                r,
                lambda v, j: F.when((i == j) & (F.get(mask, i) == 0), 1.0).otherwise(
                    v * F.get(mask, i) * F.coalesce(F.get(mask, j), F.lit(1.0))
                ),
            ),
        )

    def fitted(c: Column) -> Column:
        # Twice differenced values have no constant.
        constant = F.when(F.col("_d") + F.col("_sd") > 1, 0.0).otherwise(1.0)
        mask = F.transform(c["mask"], lambda v, i: F.when(i == 0, constant).otherwise(v))
        return let(mask, lambda mask: let(solved(masked(mask)), lambda beta: scored(c, mask, beta)))

    def scored(c: Column, mask: Column, beta: Column) -> Column:
        own = F.element_at("_normal", -1)
        sse = F.element_at(own, -1) - array_sum(F.zip_with(beta, F.slice(own, 1, 2 * len(LAGS) + 1), lambda b, v: b * v))
        k, count = array_sum(mask) + 1, F.col("_count")
        aicc = count * F.log(F.greatest(sse / count, F.lit(TINY))) + 2 * k + F.try_divide(2 * k * (k + 1), count - k - 1)
        a1, a2, a12 = (F.get(beta, F.lit(i)) for i in (1, 2, 3))
        stable = (F.abs(a1) + a2 < 1) & (a2 > -1) & (F.abs(a12) < 1)
        return F.struct(
            F.when(stable & (count - k - 1 > 0), aicc).alias("aicc"), c["i"].alias("i"), c["order"].alias("order"),
            beta.alias("beta"), F.greatest(sse, F.lit(0.0)).alias("sse"),
        )

    tried = F.transform(F.when(F.col("_count") > 0, usable), fitted)
    best = F.array_min(F.filter(tried, lambda c: c["aicc"].isNotNull()))
    w = w.withColumn("_best", best)
    told = F.struct(
        F.col("_d").alias("d"), F.col("_sd").alias("sd"), F.col("_scale").alias("scale"), F.col("_x").alias("x"),
        F.col("_e").alias("e"), F.col("_best.order").alias("order"), F.col("_best.beta").alias("beta"),
        F.col("_best.aicc").alias("aicc"), F.col("_best.sse").alias("sse"), F.col("_count").alias("rows"),
    )
    keep = ("series_key", "last_month", "ys")
    # Pinned: a condition on the result would be pushed through all steps and written out in terms of the first.
    return pinned(w.select(*keep, F.when(F.col("_best").isNotNull(), told).alias("_arma")))


def arma_values(h: int) -> Column:
    """The ``h`` forecasts of an ``arma_fit`` row, undifferenced."""
    a = F.col("_arma")
    back = lambda v, k: F.get(v, F.size(v) - k)
    begin = F.struct(
        a["x"].cast("array<double>").alias("x"), a["e"].cast("array<double>").alias("e"), F.col("ys").cast("array<double>").alias("y")
    )

    def step(acc: Column, _: Column) -> Column:
        x, e, y = acc["x"], acc["e"], acc["y"]
        known = [F.lit(1.0), *(back(v, k) for v in (x, e) for k in LAGS)]
        terms = [F.when(F.get(a["beta"], F.lit(i)) == 0, 0.0).otherwise(F.get(a["beta"], F.lit(i)) * v) for i, v in enumerate(known)]
        value = sum(terms[1:], terms[0])
        level = F.when(a["d"] == 1, back(y, 1)).otherwise(0.0) + F.when(a["sd"] == 1, back(y, SEASON)).otherwise(0.0)
        level = level - F.when((a["d"] == 1) & (a["sd"] == 1), back(y, SEASON + 1)).otherwise(0.0)
        return let(
            F.struct(value.alias("v"), level.alias("l")),
            lambda n: F.struct(
                F.concat(x, F.array(n["v"])).cast("array<double>").alias("x"),
                F.concat(e, F.array(F.lit(0.0))).cast("array<double>").alias("e"),
                F.concat(y, F.array(n["v"] * a["scale"] + n["l"])).cast("array<double>").alias("y"),
            ),
        )

    walked = F.aggregate(steps(h), begin, step)["y"]
    return F.slice(walked, F.size("ys") + 1, h)


def arma_orders(series: DataFrame) -> DataFrame:
    """``(series_key, d, p, q, sd, sp, sq, aicc, sigma)`` of the chosen models."""
    w = arma_fit(windows(series)).filter(F.col("_arma").isNotNull())
    a = F.col("_arma")
    names = ("p", "q", "sp", "sq")
    return w.select(
        "series_key", a["d"].alias("d"), *[F.get(a["order"], F.lit(i)).alias(n) for i, n in enumerate(names)], a["sd"].alias("sd"),
        a["aicc"].alias("aicc"), (F.sqrt(a["sse"] / a["rows"]) * a["scale"]).alias("sigma"),
    )


def forecast_arma(series: DataFrame, h: int = 6) -> DataFrame:
    """``(series_key, model, month, h, yhat)`` for the ``h`` months after each series that is long enough."""
    w = arma_fit(windows(series)).filter(F.col("_arma").isNotNull())
    long = _long(w, {"ARMA": arma_values(h)}, "yhat")
    return long.select(
        "series_key", "model", F.add_months("last_month", F.col("_k") + 1).alias("month"), (F.col("_k") + 1).alias("h"), "yhat"
    )

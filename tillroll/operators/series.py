"""Monthly series: gaps, calendar factors, features, splits and diagnostics.

A panel is a long table ``(series_key, month, y)``. One series is as long as
the calendar, so windows and arrays by ``series_key`` stay short however many
order lines were added up into it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillroll.functions.arrays import array_mean, array_quantile, array_sum, let, steps
from tillroll.session import pinned

SEASON = 12


def by_month() -> WindowSpec:
    return Window.partitionBy("series_key").orderBy("month")


def by_key() -> WindowSpec:
    return Window.partitionBy("series_key")


@dataclass(frozen=True)
class CalendarRule:
    """A factor for some months, in some years only when ``years`` is given."""

    months: tuple[int, ...]
    factor: float
    years: tuple[int, ...] = ()


# Monthly trend and the calendar factors.
TREND_STEP = 0.025
CALENDAR = (
    CalendarRule((4, 5, 6), 1.05),
    CalendarRule((7, 8, 9), 1.10),
    CalendarRule((10, 11, 12), 1.20),
    CalendarRule((11, 12), 1.35),
    CalendarRule((6, 7, 8), 1.20),
    CalendarRule((6, 7, 8), 1.20, (2024,)),
    CalendarRule((11, 12), 1.30, (2025,)),
)


def complete_months(series: DataFrame, value: str = "y") -> DataFrame:
    """Every month between a series' first and last one; gaps get 0.

    Each row is repeated up to the month before the next one, so the series is
    read once and not joined with itself.
    """
    following = F.lead("month").over(by_month())
    until = F.add_months(F.coalesce(following, F.add_months("month", 1)), -1)
    others = [c for c in series.columns if c not in ("series_key", "month", value)]
    own = F.col("_gap") == 0
    return (
        series.withColumn("_until", until)
        .select(
            *series.columns,
            F.posexplode(F.sequence("month", "_until", F.expr("interval 1 month"))).alias(
                "_gap", "_month"
            ),
        )
        .select(
            "series_key",
            F.col("_month").alias("month"),
            F.when(own, F.coalesce(F.col(value), F.lit(0.0))).otherwise(0.0).alias(value),
            *[F.when(own, F.col(c)).alias(c) for c in others],
        )
    )


def row_index(series: DataFrame, name: str = "month_index") -> DataFrame:
    return series.withColumn(name, F.row_number().over(by_month()))


def apply_calendar(
    series: DataFrame, rules: Sequence[CalendarRule] = CALENDAR, trend_step: float = TREND_STEP
) -> DataFrame:
    """Multiplies ``y`` by trend, season and promotion factors."""
    seasonal, promo = F.lit(1.0), F.lit(1.0)
    for rule in rules:
        applies = F.month("month").isin(list(rule.months))
        if rule.years:
            applies = applies & F.year("month").isin(list(rule.years))
            promo = promo * F.when(applies, rule.factor).otherwise(1.0)
        else:
            seasonal = seasonal * F.when(applies, rule.factor).otherwise(1.0)
    return (
        row_index(series)
        .withColumn("trend_factor", 1 + trend_step * F.col("month_index"))
        .withColumn("seasonal_factor", seasonal)
        .withColumn("promo_factor", promo)
        .withColumn(
            "y", F.col("y") * F.col("trend_factor") * F.col("seasonal_factor") * F.col("promo_factor")
        )
    )


def split(series: DataFrame, train: int = 18, test: int = 6) -> DataFrame:
    """Adds ``part`` (train, test or skip) by position from the end, and ``t``.

    ``t`` counts from 1 at the first training month. A series shorter than
    train + test is marked ``short`` throughout.
    """
    back = F.row_number().over(Window.partitionBy("series_key").orderBy(F.col("month").desc()))
    n = F.count(F.lit(1)).over(by_key())
    part = (
        F.when(F.col("_n") < train + test, "short")
        .when(F.col("_back") <= test, "test")
        .when(F.col("_back") <= train + test, "train")
        .otherwise("skip")
    )
    return (
        series.withColumn("_back", back)
        .withColumn("_n", n)
        .withColumn("part", part)
        .withColumn("t", F.lit(train + test + 1) - F.col("_back"))
        .drop("_back", "_n")
    )


def part(parted: DataFrame, name: str) -> DataFrame:
    return parted.filter(F.col("part") == name).select("series_key", "month", "y")


def lags(series: DataFrame, ks: Sequence[int] = (1, 3, 6, 12), value: str = "y") -> DataFrame:
    return series.withColumns({f"lag_{k}": F.lag(value, k).over(by_month()) for k in ks})


def moving_means(
    series: DataFrame, ks: Sequence[int] = (3, 6), value: str = "y", leak_free: bool = False
) -> DataFrame:
    """Means of the last ``k`` months, NULL until there are ``k`` of them.

    The current month is one of them unless ``leak_free`` ends the frame at
    the month before.
    """
    end = -1 if leak_free else 0

    def mean(k: int) -> Column:
        frame = by_month().rowsBetween(end - k + 1, end)
        return F.when(F.count(value).over(frame) == k, F.avg(value).over(frame))

    return series.withColumns({f"ma_{k}": mean(k) for k in ks})


FEATURES = (
    "year", "month_num", "quarter_num", "trend", "lag_1", "lag_3", "lag_6", "lag_12", "ma_3", "ma_6",
)


def ts_features(series: DataFrame, leak_free: bool = True) -> DataFrame:
    """Calendar, trend, lag and moving-mean features; incomplete rows dropped."""
    out = row_index(series, "trend").withColumns(
        {
            "year": F.year("month"),
            "month_num": F.month("month"),
            "quarter_num": F.quarter("month"),
        }
    )
    return moving_means(lags(out), leak_free=leak_free).dropna(subset=["y", *FEATURES])


def append_future(series: DataFrame, h: int = 1) -> DataFrame:
    """The history and ``h`` further months with unknown value."""
    last = F.lead("month").over(by_month()).isNull()
    own = F.struct("month", "y")
    ahead = F.transform(
        steps(h),
        lambda k: F.struct(
            F.add_months("month", k).alias("month"), F.lit(None).cast("double").alias("y")
        ),
    )
    rows = F.when(F.col("_last"), F.concat(F.array(own), ahead)).otherwise(F.array(own))
    return (
        series.select("series_key", "month", F.col("y").cast("double").alias("y"))
        .withColumn("_last", last)
        .select("series_key", F.explode(rows).alias("_r"))
        .select("series_key", "_r.month", "_r.y")
    )


# --- diagnostics --------------------------------------------------------------


def arrays(series: DataFrame) -> DataFrame:
    """One row per series: months and values in time order."""
    pairs = F.array_sort(F.collect_list(F.struct("month", "y")))
    return (
        series.groupBy("series_key")
        .agg(pairs.alias("_s"))
        .select("series_key", F.col("_s.month").alias("months"), F.col("_s.y").alias("ys"))
    )


def local_trend(
    series: DataFrame, span: float = 0.3, degree: int = 1, z: float = 1.959963984540054
) -> DataFrame:
    """Local regression over the nearest ``span`` of the months, with a band.

    Months are equally spaced, so the q nearest of position i lie in a known
    slice and the bandwidth, the q-th smallest distance, has a closed form.
    Tricube weights; the band is ``z`` standard errors of the linear smoother.
    """
    base = (
        arrays(series)
        .withColumn("_n", F.size("ys"))
        .withColumn("_q", F.floor(F.lit(span) * F.col("_n")).cast("int"))
        .select("*", F.posexplode("months").alias("_i", "month"))
    )
    edge = F.least(F.col("_i"), F.col("_n") - 1 - F.col("_i"))
    width = F.when(
        F.col("_q") <= 2 * edge + 1, F.floor(F.col("_q") / F.lit(2)).cast("int")
    ).otherwise(F.col("_q") - 1 - edge)
    base = base.withColumn("_h", width)
    first = F.greatest(F.col("_i") - F.col("_h"), F.lit(0))
    last = F.least(F.col("_i") + F.col("_h"), F.col("_n") - 1)
    near = F.transform(
        F.sequence(first, last),
        lambda j: F.struct(
            (j - F.col("_i")).cast("double").alias("d"), F.get(F.col("ys"), j).alias("y")
        ),
    )
    weight = lambda p: F.pow(
        1 - F.pow(F.abs(p["d"]) / F.greatest(F.col("_h"), F.lit(1)), F.lit(3)), F.lit(3)
    )
    weighted = F.transform(
        near, lambda p: F.struct(weight(p).alias("w"), p["d"].alias("d"), p["y"].alias("y"))
    )
    base = base.withColumn("_p", weighted)

    def moment(k: int) -> Column:
        return array_sum(F.transform("_p", lambda p: p["w"] * F.pow(p["d"], F.lit(k))))

    base = base.withColumns({f"_s{k}": moment(k) for k in range(2 * degree + 1)})
    s = [F.col(f"_s{k}") for k in range(2 * degree + 1)]
    if degree == 1:
        a, b, c, det = s[2], -s[1], F.lit(0.0), s[0] * s[2] - s[1] * s[1]
    else:
        a, b, c = s[2] * s[4] - s[3] * s[3], s[2] * s[3] - s[1] * s[4], s[1] * s[3] - s[2] * s[2]
        det = s[0] * a + s[1] * b + s[2] * c
    base = base.withColumns({"_a": a, "_b": b, "_c": c, "_det": det})
    effect = F.transform(
        "_p",
        lambda p: F.struct(
            F.try_divide(
                p["w"] * (F.col("_a") + F.col("_b") * p["d"] + F.col("_c") * p["d"] * p["d"]),
                F.col("_det"),
            ).alias("l"),
            p["y"].alias("y"),
        ),
    )
    fitted = base.withColumn("_l", effect).select(
        "series_key",
        "month",
        F.get("ys", F.col("_i")).alias("y"),
        "_n",
        array_sum(F.transform("_l", lambda e: e["l"] * e["y"])).alias("trend"),
        array_sum(F.transform("_l", lambda e: e["l"] * e["l"])).alias("_ll"),
        F.try_divide(F.col("_a"), F.col("_det")).alias("_own"),
    )
    freedom = F.col("_n") - 2 * F.sum("_own").over(by_key()) + F.sum("_ll").over(by_key())
    rss = F.sum(F.pow(F.col("y") - F.col("trend"), F.lit(2))).over(by_key())
    half = z * F.sqrt(F.when(freedom > 0, rss / freedom) * F.col("_ll"))
    return fitted.select(
        "series_key", "month", "y", "trend",
        (F.col("trend") - half).alias("lower"), (F.col("trend") + half).alias("upper"),
    )


def decompose(series: DataFrame) -> DataFrame:
    """Trend by a centred 2x12 mean, monthly season centred on 0, remainder."""
    early, late = by_month().rowsBetween(-6, 5), by_month().rowsBetween(-5, 6)
    full = F.count("y").over(by_month().rowsBetween(-6, 6)) == SEASON + 1
    trend = F.when(full, (F.avg("y").over(early) + F.avg("y").over(late)) / 2)
    same_month = Window.partitionBy("series_key", F.month("month"))
    with_season = (
        series.withColumn("trend", trend)
        .withColumn("_raw", F.avg(F.col("y") - F.col("trend")).over(same_month))
        # Every calendar month weighs the same, however many years it was seen.
        .withColumn("_w", F.when(F.col("_raw").isNotNull(), 1.0 / F.count(F.lit(1)).over(same_month)))
    )
    centre = F.sum(F.col("_raw") * F.col("_w")).over(by_key()) / F.sum("_w").over(by_key())
    return (
        with_season.withColumn("seasonal", F.col("_raw") - centre)
        .withColumn("remainder", F.col("y") - F.col("trend") - F.col("seasonal"))
        .select("series_key", "month", "y", "trend", "seasonal", "remainder")
    )


# Months that a value of the robust trend is fitted over, refits of season and trend, and rounds of new weights.
TREND_MONTHS, REFITS, ROBUST_ROUNDS = 19, 2, 3


def _local_line(values: Column, weights: Column, months: int) -> Column:
    """Local straight lines through the ``months`` nearest values, tricube in distance and weighted."""
    n = F.size(values)
    q = F.least(F.lit(months), n)

    def at(i: Column) -> Column:
        edge = F.least(i, n - 1 - i)
        reach = F.when(q <= 2 * edge + 1, F.floor(q / F.lit(2)).cast("int")).otherwise(q - 1 - edge)

        def moments(h: Column) -> Column:
            near = F.sequence(F.greatest(i - h, F.lit(0)), F.least(i + h, n - 1))
            none = F.struct(*[F.lit(0.0).alias(c) for c in ("s0", "s1", "s2", "t0", "t1")])

            def add(acc: Column, j: Column) -> Column:
                d = (j - i).cast("double")
                near = F.pow(1 - F.pow(F.abs(d) / (h + 1), F.lit(3)), F.lit(3))
                return let(
                    F.struct((near * F.get(weights, j)).alias("w"), d.alias("d"), F.get(values, j).alias("v")),
                    lambda p: F.struct(
                        (acc["s0"] + p["w"]).alias("s0"), (acc["s1"] + p["w"] * p["d"]).alias("s1"),
                        (acc["s2"] + p["w"] * p["d"] * p["d"]).alias("s2"), (acc["t0"] + p["w"] * p["v"]).alias("t0"),
                        (acc["t1"] + p["w"] * p["d"] * p["v"]).alias("t1"),
                    ),
                )

            return F.aggregate(near, none, add)

        def value(m: Column) -> Column:
            line = F.try_divide(m["s2"] * m["t0"] - m["s1"] * m["t1"], m["s0"] * m["s2"] - m["s1"] * m["s1"])
            return F.coalesce(line, F.try_divide(m["t0"], m["s0"]))

        return let(reach, lambda h: let(moments(h), value))

    return F.transform(F.sequence(F.lit(0), n - 1), at)


def _weighted_season(values: Column, weights: Column) -> Column:
    """Weighted mean of each calendar month, centred on 0; a month without weight has its median."""
    pairs = F.arrays_zip(values.alias("v"), weights.alias("w"))

    def month(m: Column) -> Column:
        own = F.filter(pairs, lambda p, i: i % SEASON == m)
        weighted = F.try_divide(array_sum(F.transform(own, lambda p: p["v"] * p["w"])), array_sum(F.transform(own, lambda p: p["w"])))
        return F.coalesce(weighted, array_quantile(F.transform(own, lambda p: p["v"]), 0.5))

    raw = F.transform(F.sequence(F.lit(0), F.least(F.lit(SEASON), F.size(values)) - 1), month)
    return let(raw, lambda r: let(array_mean(r), lambda c: F.transform(r, lambda v: v - c)))


def _bisquare(w: DataFrame) -> DataFrame:
    """Adds weights ``_rho``: 1 for no remainder ``_left``, 0 from six times the median on."""
    w = w.withColumn("_reach", 6 * array_quantile(F.col("_left"), 0.5))

    def weight(r: Column) -> Column:
        share = F.coalesce(F.try_divide(r, F.col("_reach")), F.when(r > 0, 1.0).otherwise(0.0))
        return F.pow(1 - F.pow(F.least(share, F.lit(1.0)), F.lit(2)), F.lit(2))

    return w.withColumn("_rho", F.transform("_left", weight))


def robust_decompose(series: DataFrame, months: int = TREND_MONTHS, refits: int = REFITS, rounds: int = ROBUST_ROUNDS) -> DataFrame:
    """Trend by local lines, one season for all years, remainder, and the weight each month had.

    Running medians begin. Season and trend are then fitted in turn to what the other leaves; after each
    round, months with a large remainder get less weight (bisquare, none
    beyond six times the median), so that single outliers stay in the remainder.
    """
    w = pinned(arrays(series))
    around = lambda i: F.slice("ys", F.greatest(i - SEASON // 2, F.lit(0)) + 1, F.least(i, F.lit(SEASON // 2)) + SEASON // 2 + 1)
    # Medians come first: means would hand an outlier's part to its neighbours and to its month of every year.
    w = w.withColumn("_middle", F.transform("ys", lambda y, i: array_quantile(around(i), 0.5)))
    left = F.zip_with("ys", "_middle", lambda y, t: y - t)
    w = w.withColumn("_season", _weighted_season(left, F.transform("ys", lambda y: F.lit(0.0))))
    w = w.withColumn("_adjusted", F.transform("ys", lambda y, i: y - F.get("_season", i % SEASON)))
    w = _bisquare(w.withColumn("_left", F.transform("_adjusted", lambda v, i: F.abs(v - F.get("_middle", i)))))
    w = w.withColumn("_trend", _local_line(F.col("_adjusted"), F.col("_rho"), months))
    for k in range(rounds + 1):
        for _ in range(refits):
            left = F.zip_with("ys", "_trend", lambda y, t: y - t)
            w = w.withColumn("_season", _weighted_season(left, F.col("_rho")))
            adjusted = F.transform("ys", lambda y, i: y - F.get("_season", i % SEASON))
            w = w.withColumn("_adjusted", adjusted)
            w = w.withColumn("_trend", _local_line(F.col("_adjusted"), F.col("_rho"), months))
        if k < rounds:
            w = _bisquare(w.withColumn("_left", F.transform("_adjusted", lambda v, i: F.abs(v - F.get("_trend", i)))))
        # A round's result is a few numbers a month; without this, all rounds would be one expression.
        w = pinned(w.select("series_key", "months", "ys", "_rho", "_trend", "_season"))
    rows = F.arrays_zip(F.col("months").alias("month"), F.col("ys").alias("y"), F.col("_trend").alias("trend"), F.col("_rho").alias("weight"))
    return w.select("series_key", "_season", F.posexplode(rows).alias("_i", "_r")).select(
        "series_key", "_r.month", "_r.y", "_r.trend", F.get("_season", F.col("_i") % SEASON).alias("seasonal"),
        (F.col("_r.y") - F.col("_r.trend") - F.get("_season", F.col("_i") % SEASON)).alias("remainder"), "_r.weight",
    )


def _acf_array(lags_: int) -> Column:
    ys = F.col("ys")
    centred = let(array_mean(ys), lambda m: F.transform(ys, lambda y: y - m))

    def all_lags(c: Column) -> Column:
        whole = array_sum(F.transform(c, lambda x: x * x))
        one = lambda k: array_sum(
            F.transform(c, lambda x, i: x * F.coalesce(F.get(c, i + k), F.lit(0.0)))
        )
        return F.transform(steps(lags_), lambda k: F.try_divide(one(k), whole))

    return let(centred, all_lags)


def acf(series: DataFrame, lags_: int = 24) -> DataFrame:
    """Autocorrelations of lag 1 to ``lags_`` that the series is long enough for."""
    return (
        arrays(series)
        .withColumn("_r", _acf_array(lags_))
        .select("series_key", F.size("ys").alias("_n"), F.posexplode("_r").alias("_k", "acf"))
        .withColumn("lag", F.col("_k") + 1)
        .filter(F.col("lag") < F.col("_n"))
        .select("series_key", "lag", "acf")
    )


def pacf(series: DataFrame, lags_: int = 24) -> DataFrame:
    """Partial autocorrelations by the Durbin-Levinson recursion."""
    r = F.col("_r")
    start = F.struct(
        F.array().cast("array<double>").alias("phi"), F.array().cast("array<double>").alias("out")
    )

    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        num = F.get(r, k - 1) - array_sum(
            F.transform(phi, lambda p, j: p * F.get(r, k - 2 - j))
        )
        den = 1 - array_sum(F.transform(phi, lambda p, j: p * F.get(r, j)))
        return let(
            F.try_divide(num, den),
            lambda kk: F.struct(
                F.concat(
                    F.transform(phi, lambda p, j: p - kk * F.get(phi, k - 2 - j)), F.array(kk)
                ).alias("phi"),
                F.concat(state["out"], F.array(kk)).alias("out"),
            ),
        )

    folded = F.aggregate(steps(lags_), start, step, lambda s: s["out"])
    return (
        arrays(series)
        .withColumn("_r", _acf_array(lags_))
        .select("series_key", F.size("ys").alias("_n"), F.posexplode(folded).alias("_k", "pacf"))
        .withColumn("lag", F.col("_k") + 1)
        .filter(F.col("lag") < F.col("_n"))
        .select("series_key", "lag", "pacf")
    )

"""Forecast, segment and distribution models against independent computations."""

import datetime as dt
import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from tillroll.functions import probability
from tillroll.operators import distribution, segment
from tillroll.operators import forecast as fc
from tillroll.operators import series as ts


def month(i, start=2020):
    return dt.date(start + i // 12, i % 12 + 1, 1)


def panel(spark, series, offset=0):
    rows = [(k, month(i + offset), float(y)) for k, ys in series.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "series_key string, month date, y double")


@pytest.fixture(scope="module")
def waves():
    rng = np.random.default_rng(3)
    t = np.arange(48)
    return {
        k: 100 * s + s * t + 20 * s * np.sin(2 * np.pi * t / 12 + s) + rng.normal(0, 3, 48)
        for k, s in (("a", 1.0), ("b", 2.5), ("c", 0.5))
    }


def by_step(df, model, key):
    rows = df.filter((F.col("model") == model) & (F.col("series_key") == key)).orderBy("month").collect()
    return [r["yhat"] for r in rows]


@pytest.mark.parametrize("n", [18, 29, 48])
def test_tslm_is_least_squares(spark, waves, n):
    got = fc.forecast(panel(spark, {k: v[:n] for k, v in waves.items()}), ("TSLM",))
    t = np.arange(n + 6)
    x = np.column_stack([t, *[(t % 12 == s).astype(float) for s in range(12)]])
    for k, v in waves.items():
        beta = np.linalg.lstsq(x[:n], v[:n], rcond=None)[0]
        assert by_step(got, "TSLM", k) == pytest.approx(list(x[n:] @ beta), rel=1e-9)


def test_baselines(spark, waves):
    got = fc.forecast(panel(spark, waves), fc.BASELINES, h=14)
    for k, v in waves.items():
        assert by_step(got, "Mean", k) == pytest.approx([v.mean()] * 14)
        assert by_step(got, "Naive", k) == pytest.approx([v[-1]] * 14)
        assert by_step(got, "Drift", k) == pytest.approx(
            [v[-1] + h * (v[-1] - v[0]) / 47 for h in range(1, 15)]
        )
        assert by_step(got, "Seasonal Naive", k) == pytest.approx([v[-12 + h % 12] for h in range(14)])
        assert by_step(got, "MA(3)", k) == pytest.approx([v[-3:].mean()] * 14)
        assert by_step(got, "MA(6)", k) == pytest.approx([v[-6:].mean()] * 14)


def test_short_series_give_null_not_failure(spark):
    got = fc.forecast(panel(spark, {"one": [5.0], "two": [1.0, 2.0]}), (*fc.CLOSED, *fc.FOLDED))
    assert by_step(got, "Naive", "one") == [5.0] * 6
    assert by_step(got, "Drift", "one") == [None] * 6
    assert by_step(got, "TSLM", "two") == [None] * 6
    assert got.count() == 2 * 6 * 7 + got.filter(F.col("model").isin("ETS", "AR")).count()


def test_row_count_is_models_by_steps_by_series(spark, waves):
    assert fc.forecast(panel(spark, waves)).count() == len(fc.CLOSED) * 6 * len(waves)


def smooth(ys, kind, a, b, g):
    n, first = len(ys), ys[0]
    if kind == "season":
        trend = np.mean([(ys[i] - ys[i - 12]) / 12 for i in range(12, n)])
        level = np.mean(ys[:12]) - 6.5 * trend
        season = [ys[i] - level - trend * (i + 1) for i in range(12)]
    else:
        trend = (ys[-1] - first) / (n - 1) if kind == "trend" else 0.0
        level, season = first - trend, [0.0] * 12
    sse = 0.0
    for y in ys:
        e = y - (level + trend + season[0])
        level, trend, season = level + trend + a * e, trend + b * e, [*season[1:], season[0] + g * e]
        sse += e * e
    return sse, level, trend, season


def test_smoothing_picks_the_lowest_aic(spark, waves):
    got = fc.forecast(panel(spark, waves), ("ETS",))
    for k, ys in waves.items():
        tried = [("simple", a, 0, 0, 3) for a in fc.LEVEL_GRID]
        tried += [("trend", a, b, 0, 5) for a in fc.LEVEL_GRID for b in fc.TREND_GRID]
        tried += [
            ("season", a, b, g, 17) for a in fc.LEVEL_GRID for b in fc.TREND_GRID for g in fc.SEASON_GRID
        ]
        fits = [(len(ys) * math.log(smooth(ys, *c[:4])[0] / len(ys)) + 2 * c[4], c) for c in tried]
        _, level, trend, season = smooth(ys, *min(fits)[1][:4])
        want = [level + h * trend + season[h - 1] for h in range(1, 7)]
        assert by_step(got, "ETS", k) == pytest.approx(want)


def test_autoregression_is_least_squares_on_the_lag(spark):
    rng = np.random.default_rng(1)
    y = [10.0]
    for _ in range(200):
        y.append(4 + 0.6 * y[-1] + rng.normal(0, 0.5))
    fitted = fc._ar_fit(fc.windows(panel(spark, {"x": y}, offset=0))).first()["_ar"]
    phi, const = np.polyfit(y[:-1], y[1:], 1)
    assert fitted["d"] == 0
    assert (fitted["phi"], fitted["c"]) == (pytest.approx(phi), pytest.approx(const))
    got = by_step(fc.forecast(panel(spark, {"x": y}), ("AR",)), "AR", "x")
    last = y[-1]
    for value in got:
        last = fitted["c"] + fitted["phi"] * last
        assert value == pytest.approx(last)


def test_seasonal_autoregression_past_one_season(spark, waves):
    got = by_step(fc.forecast(panel(spark, waves), ("AR",), h=24), "AR", "a")
    assert len(got) == 24 and all(math.isfinite(v) for v in got)


@pytest.mark.parametrize("offset", [0, 5])
def test_harmonic_is_ridge_regression_whatever_the_start(spark, waves, offset):
    n, h, ridge = 30, 6, 0.1
    got = fc.forecast_harmonic(panel(spark, {k: v[:n] for k, v in waves.items()}, offset), h)
    t = np.arange(1, n + h + 1) + offset
    x = np.column_stack(
        [np.arange(1, n + h + 1) / n, *[f(2 * np.pi * k * t / 12) for k in (1, 2) for f in (np.sin, np.cos)]]
    )
    centre = x[:n].mean(axis=0)
    for k, v in waves.items():
        xc, y = x[:n] - centre, v[:n] - v[:n].mean()
        beta = np.linalg.solve(xc.T @ xc + ridge * np.eye(5), xc.T @ y)
        want = v[:n].mean() + (x - centre) @ beta
        assert by_step(got, "Harmonic", k) == pytest.approx(list(want))


def test_accuracy_handles_zero_months_and_short_history(spark):
    test = panel(spark, {"a": [0.0, 10.0]}, offset=12)
    forecasts = test.select("series_key", "month", F.lit("m").alias("model"), F.lit(8.0).alias("yhat"))
    row = fc.accuracy(forecasts, test, panel(spark, {"a": [1.0] * 12})).first()
    assert (row["mae"], row["mape"], row["zero_months"], row["mase"]) == (5.0, pytest.approx(20), 1, None)
    assert row["rmse"] >= row["mae"]


def test_future_uses_the_winner_on_the_full_history(spark, waves):
    full = panel(spark, waves)
    best = spark.createDataFrame([("a", "Naive"), ("b", "TSLM"), ("c", "MA(3)")], "series_key string, model string")
    got = fc.future(full, best)
    every = fc.forecast(full)
    for r in best.collect():
        assert by_step(got, r["model"], r["series_key"]) == pytest.approx(
            by_step(every, r["model"], r["series_key"])
        )


def test_interval_widths(spark, waves):
    row = fc.intervals(panel(spark, waves)).filter("model = 'Naive' and series_key = 'a'").orderBy("month").collect()
    d = np.diff(waves["a"])
    sigma = math.sqrt((d**2).sum() / 47)
    for h, r in enumerate(row, 1):
        assert r["hi80"] - r["yhat"] == pytest.approx(NormalDist().inv_cdf(0.9) * sigma * math.sqrt(h))
    none = fc.intervals(panel(spark, waves)).filter("model = 'MA(3)'").first()
    assert none["lo80"] is None and none["hi80"] is None


def test_boosted_trees_do_not_look_ahead(spark, waves):
    base = ts.split(panel(spark, waves))
    bent = base.withColumn("y", F.when(F.col("part") == "test", F.col("y") * 100).otherwise(F.col("y")))
    a = fc.forecast_boosted(base, "g", depth=2, rounds=5).orderBy("series_key", "month").collect()
    b = fc.forecast_boosted(bent, "g", depth=2, rounds=5).orderBy("series_key", "month").collect()
    assert len(a) == 18
    assert [r["month"] for r in a[:6]] == [month(i) for i in range(42, 48)]
    assert [r["yhat"] for r in a] == pytest.approx([r["yhat"] for r in b])


def test_boosted_trees_beat_the_mean_in_training(spark, waves):
    rows = fc.boosted_features(ts.split(panel(spark, waves)), leak_free=False)
    model = fc.fit_boosted(rows, depth=3, rounds=20)
    train = rows.filter(F.col("part") == "train")
    fits = fc.predict_rows(model, train, "g").join(train, ["series_key", "month"])
    err = fits.agg(
        F.avg(F.pow(F.col("y") - F.col("yhat"), F.lit(2))).alias("m"),
        F.avg(F.pow(F.col("y") - F.col("scale"), F.lit(2))).alias("s"),
    ).first()
    assert err["m"] < 0.5 * err["s"]


# --- diagnostics ----------------------------------------------------------------


def test_acf_and_pacf(spark, waves):
    p = panel(spark, waves)
    for k, v in waves.items():
        z = v - v.mean()
        r = np.array([(z[i:] * z[: len(z) - i]).sum() / (z * z).sum() for i in range(25)])
        got = [x["acf"] for x in ts.acf(p).filter(F.col("series_key") == k).orderBy("lag").collect()]
        assert got == pytest.approx(list(r[1:]))
        part = [x["pacf"] for x in ts.pacf(p).filter(F.col("series_key") == k).orderBy("lag").collect()]
        want = [
            np.linalg.solve([[r[abs(i - j)] for j in range(n)] for i in range(n)], r[1 : n + 1])[-1]
            for n in range(1, 25)
        ]
        assert part == pytest.approx(want, rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("degree", [1, 2])
def test_local_trend_is_weighted_least_squares(spark, waves, degree):
    got = ts.local_trend(panel(spark, waves), degree=degree).filter("series_key = 'b'").orderBy("month").collect()
    y, n = waves["b"], 48
    q, t = int(0.3 * n), np.arange(n, dtype=float)
    for i, r in enumerate(got):
        d = np.abs(t - i)
        width = np.sort(d)[q - 1]
        w = np.sqrt(np.where(d < width, (1 - (d / width) ** 3) ** 3, 0))
        x = np.column_stack([(t - i) ** k for k in range(degree + 1)])
        want = np.linalg.lstsq(x * w[:, None], y * w, rcond=None)[0][0]
        assert r["trend"] == pytest.approx(want)
        assert r["lower"] < r["trend"] < r["upper"]


def test_decomposition_adds_up(spark, waves):
    rows = ts.decompose(panel(spark, waves)).filter("trend is not null").collect()
    for r in rows:
        assert r["trend"] + r["seasonal"] + r["remainder"] == pytest.approx(r["y"])
    one = {r["month"].month: r["seasonal"] for r in rows if r["series_key"] == "a"}
    assert sum(one.values()) == pytest.approx(0, abs=1e-9)


# --- segments ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    xs = np.vstack([rng.normal(c, 1, (40, 3)) for c in ((0, 0, 0), (8, 8, 0), (0, 8, 8))])
    rows = [(i, *map(float, x), 4.0) for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "id int, x double, y double, z double, flat double")


COLUMNS = ["x", "y", "z", "flat"]


def test_constant_features_are_dropped(blobs):
    assert segment.drop_constant(blobs, COLUMNS) == ["x", "y", "z"]
    with pytest.raises(ValueError, match="two"):
        segment.drop_constant(blobs, ["x", "flat"])
    row = segment.feature_variance(blobs, COLUMNS).filter("constant").first()
    assert (row["feature"], row["only_value"]) == ("flat", 4.0)


def test_scaled_features_have_mean_0_and_sd_1(blobs):
    scaled, z = segment.scaled_features(blobs, COLUMNS)
    for c in z:
        row = scaled.agg(F.avg(c), F.stddev_samp(c)).first()
        assert tuple(row) == (pytest.approx(0, abs=1e-9), pytest.approx(1))


def test_scaling_a_constant_fails(blobs):
    with pytest.raises(Exception, match="not finite"):
        segment.standardize(blobs, ["flat"]).collect()


def test_kmeans_finds_the_groups_in_order_of_size(blobs):
    got = segment.segment(blobs, COLUMNS, k=3, rank_by="x", restarts=4).collect()
    groups = [{r["cluster"] for r in got if r["id"] // 40 == g} for g in range(3)]
    assert all(len(g) == 1 for g in groups)
    assert groups[1] == {3}


def test_best_of_many_starts(blobs):
    scaled, _ = segment.scaled_features(blobs, COLUMNS)
    costs = [segment._kmeans(5, s).fit(scaled).summary.trainingCost for s in range(42, 47)]
    assert segment.best_kmeans(scaled, 5, restarts=5).summary.trainingCost == pytest.approx(min(costs))


def test_wss_falls_with_k(blobs):
    scaled, _ = segment.scaled_features(blobs, COLUMNS)
    wss = [r["wss"] for r in segment.wss_by_k(scaled, 6).orderBy("k").collect()]
    assert wss[0] == pytest.approx(3 * 119) and wss[2] < 0.2 * wss[0]
    best = [r["silhouette"] for r in segment.silhouette_by_k(scaled, 6).orderBy("k").collect()]
    assert int(np.argmax(best)) + 2 == 3


def test_silhouette_equals_the_pairwise_definition(blobs):
    scaled, z = segment.scaled_features(blobs, COLUMNS)
    tagged = scaled.withColumn("cluster", F.when(F.col("id") == 0, 9).otherwise(F.col("id") % 3))
    got = {r["id"]: r for r in segment.silhouette_detail(tagged, z, "id").collect()}
    rows = tagged.collect()
    x, c = np.array([[r[v] for v in z] for r in rows]), np.array([r["cluster"] for r in rows])
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    for i, r in enumerate(rows):
        own = (c == c[i]) & (np.arange(len(c)) != i)
        b = min(d[i, c == o].mean() for o in set(c) - {c[i]})
        want = 0.0 if not own.any() else (b - d[i, own].mean()) / max(b, d[i, own].mean())
        assert got[r["id"]]["sil_width"] == pytest.approx(want, abs=1e-9)
    mean = np.mean([r["sil_width"] for r in got.values()])
    judge = ClusteringEvaluator(predictionCol="p", featuresCol="features")
    assert judge.evaluate(tagged.withColumn("p", F.col("cluster").cast("double"))) == pytest.approx(mean)


def test_components_are_uncorrelated_and_signed(blobs):
    scaled, z = segment.scaled_features(blobs, COLUMNS)
    got = segment.principal_components(scaled, ["id", *z])
    assert got.agg(F.corr("PC1", "PC2")).first()[0] == pytest.approx(0, abs=1e-9)
    x = np.array([[r[v] for v in z] for r in got.orderBy("id").collect()])
    top = np.linalg.eigh(x.T @ x)[1][:, -1]
    top *= np.sign(top[np.argmax(np.abs(top))])
    assert [r["PC1"] for r in got.orderBy("id").collect()] == pytest.approx(list(x @ top))


# --- distributions ------------------------------------------------------------------


def test_normal_quantile(spark):
    ps = [0.001, 0.01, 0.02425, 0.1, 0.5, 0.77, 0.99, 0.9999]
    df = spark.createDataFrame([(p,) for p in ps], "p double").select(
        "p", probability.normal_quantile(F.col("p")).alias("z")
    )
    for r in df.collect():
        assert r["z"] == pytest.approx(NormalDist().inv_cdf(r["p"]), abs=1e-7)


def test_log_gamma(spark):
    xs = [0.01, 0.5, 1.0, 2.0, 3.7, 50.0, 12345.6]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select(
        "x", probability.log_gamma(F.col("x")).alias("g")
    )
    for r in df.collect():
        assert r["g"] == pytest.approx(math.lgamma(r["x"]), rel=1e-10, abs=1e-10)


def test_negative_binomial_fit(spark):
    rng = np.random.default_rng(11)
    sample = rng.negative_binomial(3.0, 3.0 / (3.0 + 8.0), 20000)
    values, counts = np.unique(sample, return_counts=True)
    freq = spark.createDataFrame(
        [(int(v), int(c)) for v, c in zip(values, counts)], "freq bigint, customers bigint"
    )
    row = distribution.negative_binomial_fit(freq).first()
    assert row["mu"] == pytest.approx(sample.mean())
    assert row["size"] == pytest.approx(3.0, rel=0.06)
    table = distribution.frequency_fit(freq).collect()
    assert sorted(r["x"] for r in table) == values.tolist()
    assert sum(r["negative_binomial"] for r in table) == pytest.approx(20000, rel=1e-3)
    assert sum(r["poisson"] for r in table) == pytest.approx(20000, rel=1e-3)


def test_no_overdispersion_gives_no_negative_binomial(spark):
    freq = spark.createDataFrame([(4, 10), (5, 10)], "freq bigint, customers bigint")
    table = distribution.frequency_fit(freq).collect()
    assert all(r["negative_binomial"] is None for r in table)
    assert all(r["poisson"] > 0 for r in table)


def test_box_whiskers(spark):
    vs = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([("g", float(v)) for v in vs], "g string, v double")
    row = distribution.box_stats(df, "v", ["g"]).first()
    assert (row["q1"], row["median"], row["q3"]) == (3, 5, 7)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"], row["n"]) == (1, 8, 1, 9)


def test_histogram_counts_everything(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"))
    rows = distribution.histogram(df, "v", 10).collect()
    assert sum(r["n"] for r in rows) == 1000
    assert sum(r["density"] * (r["high"] - r["low"]) for r in rows) == pytest.approx(1)
    same = distribution.histogram(spark.range(5).select(F.lit(3.0).alias("v")), "v", 10).collect()
    assert [(r["bin"], r["n"]) for r in same] == [(0, 5)]


def test_density_matches_the_direct_sum(spark):
    rng = np.random.default_rng(2)
    v = rng.gamma(2, 10, 3000)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    rows = sorted(distribution.density(df, "v").collect(), key=lambda r: r["x"])
    q1, q3 = np.quantile(v, [0.25, 0.75])
    bw = 0.9 * min(v.std(ddof=1), (q3 - q1) / 1.34) * len(v) ** -0.2
    for r in rows[::64]:
        want = np.exp(-0.5 * ((r["x"] - v) / bw) ** 2).sum() / (len(v) * bw * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(want, rel=2e-3, abs=1e-6)


def test_trend_line(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(0, 10, 200)
    y = 3 + 2 * x + rng.normal(0, 1, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    row = distribution.linear_trend(df, "x", "y").first()
    design = np.column_stack([np.ones(200), x])
    beta, sse = np.linalg.lstsq(design, y, rcond=None)[:2]
    cov = sse[0] / 198 * np.linalg.inv(design.T @ design)
    assert (row["intercept"], row["slope"]) == (pytest.approx(beta[0]), pytest.approx(beta[1]))
    assert row["slope_se"] == pytest.approx(math.sqrt(cov[1, 1]))


def test_segments_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(9)
    rows = [(i, *map(float, rng.normal(size=3) + 4 * (i % 3))) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double")
    found = [
        {r["k"]: r["cluster"] for r in segment.segment(df.repartition(n), ["a", "b", "c"], 3, "a", restarts=2).collect()}
        for n in (1, 5)
    ]
    assert found[0] == found[1]


def test_interval_of_the_regression_holds_its_share(spark):
    rng = np.random.default_rng(12)
    rows, ahead = [], {}
    for s in range(400):
        t = np.arange(1, 43)
        y = 100 + 2 * t + 20 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 5, 42)
        rows += [(f"s{s}", dt.date(2020 + i // 12, i % 12 + 1, 1), float(y[i])) for i in range(36)]
        ahead.update({(f"s{s}", dt.date(2020 + i // 12, i % 12 + 1, 1)): y[i] for i in range(36, 42)})
    series = spark.createDataFrame(rows, "series_key string, month date, y double")
    got = fc.intervals(series, ("TSLM",)).collect()
    inside = [r["lo80"] <= ahead[r["series_key"], r["month"]] <= r["hi80"] for r in got]
    assert len(inside) == 2400 and 0.76 < sum(inside) / len(inside) < 0.84


def test_series_with_a_mean_of_zero_keep_their_boosted_forecast(spark):
    months = [dt.date(2020 + i // 12, i % 12 + 1, 1) for i in range(36)]
    rows = [(k, m, v(i)) for k, v in (("zero", lambda i: 0.0), ("up", lambda i: 5.0 + i)) for i, m in enumerate(months)]
    parted = ts.split(spark.createDataFrame(rows, "series_key string, month date, y double"))
    got = fc.forecast_boosted(parted, "GBT small", depth=2, rounds=3).groupBy("series_key").count().collect()
    assert {r["series_key"]: r["count"] for r in got} == {"zero": 6, "up": 6}


def test_student_quantiles():
    from tillroll.functions.probability import t90_table

    table = t90_table()
    assert [table[i] for i in (0, 1, 4, 9, 29)] == pytest.approx([3.07768, 1.88562, 1.47588, 1.37218, 1.31042], abs=1e-4)

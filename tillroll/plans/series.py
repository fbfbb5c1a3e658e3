"""Monthly series, forecasts and their scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import rounded
from tillroll.functions.probability import t90_table
from tillroll.operators import forecast as fc
from tillroll.operators import reports
from tillroll.operators import series as ts
from tillroll.plans.common import fact, show
from tillroll.plans.registry import q, query
from tillroll.session import pinned
from tillroll.sources.star import load_star

# The fixture's calendar: the general rules plus promotions in its own years.
RULES = (
    *(r for r in ts.CALENDAR if not r.years),
    ts.CalendarRule((6, 7, 8), 1.20, (2000,)),
    ts.CalendarRule((11, 12), 1.30, (2000,)),
)

SERIES_SQL = """
    m AS (
        SELECT root_category AS series_key, CAST(date_trunc('month', order_date) AS DATE) AS month,
            sum(line_total) AS amount
        FROM s_fact GROUP BY ALL),
    spine AS (
        SELECT series_key, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
        FROM (SELECT series_key, min(month) AS lo, max(month) AS hi FROM m GROUP BY 1)),
    gapless AS (
        SELECT series_key, month, coalesce(amount, 0) AS base,
            row_number() OVER (PARTITION BY series_key ORDER BY month) AS i,
            month(month) AS mm, year(month) AS yy
        FROM spine LEFT JOIN m USING (series_key, month)),
    factors AS (
        SELECT *, 1 + 0.025e0 * i AS trend_factor,
            (CASE WHEN mm IN (4, 5, 6) THEN 1.05e0 WHEN mm IN (7, 8, 9) THEN 1.1e0
                WHEN mm IN (10, 11, 12) THEN 1.2e0 ELSE 1e0 END)
            * (CASE WHEN mm >= 11 THEN 1.35e0 ELSE 1e0 END)
            * (CASE WHEN mm IN (6, 7, 8) THEN 1.2e0 ELSE 1e0 END) AS seasonal_factor,
            (CASE WHEN yy = 2000 AND mm IN (6, 7, 8) THEN 1.2e0 ELSE 1e0 END)
            * (CASE WHEN yy = 2000 AND mm >= 11 THEN 1.3e0 ELSE 1e0 END) AS promo_factor
        FROM gapless),
    series AS (
        SELECT series_key, month, i, base * trend_factor * seasonal_factor * promo_factor AS y
        FROM factors),
    parted AS (
        SELECT *, CASE WHEN n < 24 THEN 'short' WHEN back <= 6 THEN 'test' WHEN back <= 24 THEN 'train'
            ELSE 'skip' END AS part, 25 - back AS t
        FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY month DESC) AS back,
            count(*) OVER (PARTITION BY series_key) AS n FROM series)),
    train AS (SELECT series_key, month, y, t FROM parted WHERE part = 'train'),
    test AS (SELECT series_key, month, y, t FROM parted WHERE part = 'test'),
    ends AS (
        SELECT series_key, max(month) AS last_month, count(*) AS n, avg(y) AS mean_y,
            arg_max(y, month) AS last_y, arg_min(y, month) AS first_y
        FROM train GROUP BY 1),
    ahead AS (
        SELECT e.*, CAST(h AS INTEGER) AS h, CAST(last_month + h * INTERVAL 1 MONTH AS DATE) AS month
        FROM ends e, range(1, 7) r(h))"""


def raw_series(spark, sf_dir):
    """Monthly sales per root category."""
    lines = fact(load_star(spark, sf_dir), "root_category", "order_date", "line_total")
    monthly = reports.monthly_amount(lines, ["root_category"])
    return monthly.select(F.col("root_category").alias("series_key"), "month", F.col("amount").alias("y"))


def panel(spark, sf_dir):
    adjusted = ts.apply_calendar(ts.complete_months(raw_series(spark, sf_dir)), RULES)
    return adjusted.select("series_key", "month", "y")


def parted(spark, sf_dir):
    return ts.split(panel(spark, sf_dir))


def pinned_parts(spark, sf_dir):
    """The split panel, kept: several steps read it and it is tiny, the lines are not."""
    return pinned(parted(spark, sf_dir))


def train(spark, sf_dir):
    return ts.part(parted(spark, sf_dir), "train")


@query(
    "month_spine",
    f"""{SERIES_SQL} SELECT series_key, month, {q('base')} AS y FROM gapless""",
)
def month_spine(spark, sf_dir):
    return show(ts.complete_months(raw_series(spark, sf_dir)))


@query(
    "month_spine_gaps",
    """
    m AS (
        SELECT brand || '|' || color AS series_key, CAST(date_trunc('month', order_date) AS DATE) AS month,
            sum(quantity) AS y
        FROM s_fact GROUP BY ALL),
    spine AS (
        SELECT series_key, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
        FROM (SELECT series_key, min(month) AS lo, max(month) AS hi FROM m GROUP BY 1))
    SELECT series_key, month, coalesce(y, 0) AS y FROM spine LEFT JOIN m USING (series_key, month)
    """,
)
def month_spine_gaps(spark, sf_dir):
    """Colours of a brand, of which many sell nothing in some months between their first and last."""
    lines = fact(load_star(spark, sf_dir), "brand", "color", "order_date", "quantity")
    monthly = reports.monthly_qty(lines, ["brand", "color"])
    return ts.complete_months(
        monthly.select(F.concat_ws("|", "brand", "color").alias("series_key"), "month", F.col("qty").alias("y"))
    )


@query(
    "calendar_factors",
    f"""{SERIES_SQL}
    SELECT series_key, month, CAST(i AS INTEGER) AS month_index, {q('trend_factor')} AS trend_factor,
        {q('seasonal_factor')} AS seasonal_factor, {q('promo_factor')} AS promo_factor,
        {q('base * trend_factor * seasonal_factor * promo_factor', 2)} AS y
    FROM factors""",
)
def calendar_factors(spark, sf_dir):
    out = ts.apply_calendar(ts.complete_months(raw_series(spark, sf_dir)), RULES)
    return show(out.withColumn("y", rounded("y", 2)))


@query(
    "win_lags",
    f"""{SERIES_SQL}
    SELECT series_key, month, {q('y', 2)} AS y,
        {', '.join(f"{q(f'lag(y, {k}) OVER (PARTITION BY series_key ORDER BY month)', 2)} AS lag_{k}"
                   for k in (1, 3, 6, 12))}
    FROM series""",
)
def win_lags(spark, sf_dir):
    return show(ts.lags(panel(spark, sf_dir)), 2)


def _ma_sql(k, end="CURRENT ROW", start=None):
    frame = f"(PARTITION BY series_key ORDER BY month ROWS BETWEEN {start or k - 1} PRECEDING AND {end})"
    return f"CASE WHEN count(y) OVER {frame} = {k} THEN avg(y) OVER {frame} END"


@query(
    "win_moving_mean",
    f"""{SERIES_SQL}
    SELECT series_key, month, {q(_ma_sql(3), 2)} AS ma_3, {q(_ma_sql(6), 2)} AS ma_6 FROM series""",
)
def win_moving_mean(spark, sf_dir):
    return show(ts.moving_means(panel(spark, sf_dir)).drop("y"), 2)


@query(
    "win_row_index",
    f"""{SERIES_SQL} SELECT series_key, month, CAST(i AS INTEGER) AS month_index FROM series""",
)
def win_row_index(spark, sf_dir):
    return ts.row_index(panel(spark, sf_dir)).drop("y")


@query(
    "append_future_rows",
    f"""{SERIES_SQL}
    SELECT series_key, month, {q('y', 2)} AS y FROM series
    UNION ALL
    SELECT series_key, CAST(max(month) + INTERVAL 1 MONTH AS DATE), NULL FROM series GROUP BY 1""",
)
def append_future_rows(spark, sf_dir):
    return show(ts.append_future(panel(spark, sf_dir)), 2)


@query(
    "ts_split",
    f"""{SERIES_SQL}
    SELECT series_key, month, {q('y', 2)} AS y, part, CAST(t AS INTEGER) AS t FROM parted""",
)
def ts_split(spark, sf_dir):
    return show(parted(spark, sf_dir), 2)


def _features_sql(leak_free):
    end, extra = ("1 PRECEDING", 1) if leak_free else ("CURRENT ROW", 0)
    lag = "lag(y, {k}) OVER (PARTITION BY series_key ORDER BY month)"
    return f"""{SERIES_SQL},
    f AS (
        SELECT series_key, month, y, CAST(year(month) AS INTEGER) AS year,
            CAST(month(month) AS INTEGER) AS month_num, CAST(quarter(month) AS INTEGER) AS quarter_num,
            CAST(i AS INTEGER) AS trend,
            {', '.join(f"{q(lag.format(k=k), 2)} AS lag_{k}" for k in (1, 3, 6, 12))},
            {', '.join(f"{q(_ma_sql(k, end, k - 1 + extra), 2)} AS ma_{k}" for k in (3, 6))}
        FROM series)
    SELECT * REPLACE ({q('y', 2)} AS y) FROM f WHERE lag_12 IS NOT NULL AND ma_6 IS NOT NULL"""


@query("ts_features", _features_sql(True))
def ts_features(spark, sf_dir):
    return show(ts.ts_features(panel(spark, sf_dir), leak_free=True), 2)


@query("ts_features_parity", _features_sql(False))
def ts_features_parity(spark, sf_dir):
    return show(ts.ts_features(panel(spark, sf_dir), leak_free=False), 2)


# --- closed-form models ---------------------------------------------------------


# --- models in SQL ----------------------------------------------------------------
#
# Each builder adds the steps of some models over a table ``src`` of
# (series_key, month, y, t); ``p`` keeps the names for training and full history apart.


def _closed_sql(src, p=""):
    return f"""
    {p}season AS (
        SELECT series_key, t % 12 AS s, avg(y) AS ys, avg(t) AS ts, count(*) AS cnt FROM {src} GROUP BY 1, 2),
    {p}slope AS (
        SELECT x.series_key, sum((t - ts) * (y - ys)) / sum((t - ts) * (t - ts)) AS b,
            sum((t - ts) * (t - ts)) AS den
        FROM {src} x JOIN {p}season z ON z.series_key = x.series_key AND z.s = x.t % 12
        GROUP BY 1)"""


def _ets_sql(src, p=""):
    return f"""
    {p}levels AS (SELECT unnest([0.1e0, 0.2e0, 0.3e0, 0.4e0, 0.5e0, 0.6e0, 0.7e0, 0.8e0, 0.9e0]) AS a),
    {p}small AS (SELECT unnest([0.05e0, 0.1e0, 0.2e0]) AS v),
    {p}grid AS (
        SELECT 'simple' AS kind, a, 0e0 AS b, 0e0 AS g, 3 AS k, 1 AS rank FROM {p}levels
        UNION ALL SELECT 'trend', a, v, 0e0, 5, 2 FROM {p}levels, {p}small
        UNION ALL SELECT 'season', a, x.v, z.v, 17, 3 FROM {p}levels, {p}small x, {p}small z),
    {p}hist AS (SELECT series_key, max(month) AS last_month, list(y ORDER BY month) AS ys, count(*) AS n
        FROM {src} GROUP BY 1),
    {p}init AS (
        SELECT *, (ys[n] - ys[1]) / (n - 1) AS slope0,
            list_avg(list_transform(range(13, n + 1), lambda i: (ys[i] - ys[i - 12]) / 12)) AS yearly,
            list_avg(ys[1:12]) AS mean12
        FROM {p}hist),
    {p}started AS (
        SELECT series_key, last_month, ys, n, kind, a, b AS wb, g, k, rank, CAST(0 AS BIGINT) AS t,
            CASE kind WHEN 'season' THEN mean12 - yearly * 6.5 WHEN 'trend' THEN ys[1] - slope0
                ELSE ys[1] END AS l,
            CASE kind WHEN 'season' THEN yearly WHEN 'trend' THEN slope0 ELSE 0e0 END AS b,
            CASE kind WHEN 'season' THEN list_transform(range(1, 13),
                lambda i: ys[i] - (mean12 - yearly * 6.5) - yearly * i)
                ELSE list_transform(range(1, 13), lambda i: 0e0) END AS s,
            0e0 AS sse, CAST([] AS DOUBLE[]) AS fits
        FROM {p}init, {p}grid),
    {p}walk AS (
        WITH RECURSIVE w AS (
            SELECT * FROM {p}started
            UNION ALL
            SELECT series_key, last_month, ys, n, kind, a, wb, g, k, rank, t + 1,
                l + b + a * e, b + wb * e, list_append(s[2:12], s[1] + g * e), sse + e * e,
                list_append(fits, l + b + s[1])
            FROM (SELECT *, ys[t + 1] - (l + b + s[1]) AS e FROM w WHERE t < n))
        SELECT * FROM w WHERE t = n),
    {p}ets AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_key
            ORDER BY n * ln(greatest(sse / n, 1e-12)) + 2 * k, rank, a, wb, g) AS place FROM {p}walk)
        WHERE place = 1)"""


def _ar_sql(src, p=""):
    return f"""
    {p}x AS (
        SELECT series_key, 0 AS d, t, y AS x FROM {src}
        UNION ALL SELECT a.series_key, 1, a.t, a.y - p.y FROM {src} a JOIN {src} p
            ON p.series_key = a.series_key AND p.t = a.t - 1
        UNION ALL SELECT a.series_key, 12, a.t, a.y - p.y FROM {src} a JOIN {src} p
            ON p.series_key = a.series_key AND p.t = a.t - 12),
    {p}sums AS (
        SELECT v.series_key, v.d, count(*) AS m, regr_sxx(v.x, u.x) AS sxx, regr_syy(v.x, u.x) AS syy,
            regr_sxy(v.x, u.x) AS sxy, avg(u.x) AS mb, avg(v.x) AS ma
        FROM {p}x v JOIN {p}x u ON u.series_key = v.series_key AND u.d = v.d AND u.t = v.t - 1
        GROUP BY 1, 2 HAVING count(*) >= 4),
    {p}cand AS (
        SELECT series_key, d, 0e0 AS phi, ma AS c, ln(greatest(syy / m, 1e-12)) + 4e0 / m AS aic,
            syy AS sse, m - 1 AS free
        FROM {p}sums
        UNION ALL
        SELECT series_key, d, sxy / sxx, ma - sxy / sxx * mb,
            ln(greatest((syy - sxy / sxx * sxy) / m, 1e-12)) + 6e0 / m, syy - sxy / sxx * sxy, m - 2
        FROM {p}sums WHERE abs(sxy / sxx) < 1),
    {p}ar AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY aic, d, phi) AS place
            FROM {p}cand) WHERE place = 1),
    {p}ar_ahead AS (
        SELECT s.series_key, a.month, a.h, CASE s.d WHEN 0 THEN xh
            WHEN 1 THEN last_y + sum(xh) OVER (PARTITION BY s.series_key ORDER BY s.h) ELSE o.y + xh END AS yhat
        FROM (
            SELECT b.series_key, b.d, a.h, e.n, x.x * pow(phi, a.h) + c * (1 - pow(phi, a.h)) / (1 - phi) AS xh
            FROM {p}ar b JOIN {p}ends e ON e.series_key = b.series_key
            JOIN {p}x x ON x.series_key = b.series_key AND x.d = b.d AND x.t = e.n
            JOIN {p}ahead a ON a.series_key = b.series_key) s
        JOIN {p}ahead a ON a.series_key = s.series_key AND a.h = s.h
        JOIN {src} o ON o.series_key = s.series_key AND o.t = s.n - 12 + s.h)"""


def _harmonic_sql(src, p="", columns=5, ridge=0.1):
    """Ridge regression as least squares with extra rows, solved by Gram-Schmidt for each length.

    Rows 1 to n are the months fitted, the next six the forecast (weight 0), and
    negative ones the penalty.
    """
    steps = [f"""
    {p}x0 AS (
        SELECT n, r, j, v - CASE WHEN r > 0 THEN avg(v) FILTER (r BETWEEN 1 AND n) OVER (PARTITION BY n, j)
            ELSE 0 END AS v, CASE WHEN r <= n THEN 1 ELSE 0 END AS w
        FROM (
            SELECT n, r, j, CASE j WHEN 1 THEN r / CAST(n AS DOUBLE) WHEN 2 THEN sin(2 * pi() * r / 12)
                WHEN 3 THEN cos(2 * pi() * r / 12) WHEN 4 THEN sin(4 * pi() * r / 12)
                ELSE cos(4 * pi() * r / 12) END AS v
            FROM (SELECT n, unnest(range(1, n + 7)) AS r FROM (SELECT DISTINCT n FROM {p}ends)),
                range(1, {columns + 1}) c(j)
            UNION ALL
            SELECT n, -i, j, CASE WHEN i = j THEN sqrt({ridge}e0) ELSE 0e0 END
            FROM (SELECT DISTINCT n FROM {p}ends), range(1, {columns + 1}) a(i), range(1, {columns + 1}) c(j)))"""]
    for k in range(1, columns + 1):
        steps.append(f"""
    {p}q{k} AS (
        SELECT n, r, w, v / sqrt(sum(v * v) FILTER (w = 1) OVER (PARTITION BY n)) AS v
        FROM {p}x{k - 1} WHERE j = {k}),
    {p}d{k} AS (
        SELECT n, j, sum(x.v * q.v) AS d FROM {p}x{k - 1} x JOIN {p}q{k} q USING (n, r)
        WHERE x.w = 1 AND j > {k} GROUP BY n, j),
    {p}x{k} AS (
        SELECT x.n, x.r, x.j, x.w, x.v - d * q.v AS v
        FROM {p}x{k - 1} x JOIN {p}q{k} q ON q.n = x.n AND q.r = x.r
        JOIN {p}d{k} d ON d.n = x.n AND d.j = x.j)""")
    union = " UNION ALL ".join(f"SELECT {k} AS k, n, r, v FROM {p}q{k}" for k in range(1, columns + 1))
    return ",".join(steps) + f""",
    {p}basis AS ({union}),
    {p}weight AS (
        SELECT x.series_key, e.n, k, sum(v * (y - mean_y)) AS c
        FROM {src} x JOIN {p}ends e ON e.series_key = x.series_key
        JOIN {p}basis b ON b.n = e.n AND b.r = x.t GROUP BY 1, 2, 3),
    {p}fit AS (
        SELECT w.series_key, w.n, r, max(mean_y) + sum(c * v) AS yhat
        FROM {p}weight w JOIN {p}ends e ON e.series_key = w.series_key
        JOIN {p}basis b ON b.n = w.n AND b.k = w.k WHERE r > 0 GROUP BY 1, 2, 3)"""


def _models_sql(src, p=""):
    return ",".join(f(src, p) for f in (_closed_sql, _ets_sql, _ar_sql, _harmonic_sql))


def _forecasts_sql(models, src="train", p=""):
    back = f"""FROM {p}ahead a JOIN {src} t ON t.series_key = a.series_key"""
    per_model = {
        "Mean": f"SELECT series_key, month, h, mean_y AS yhat FROM {p}ahead",
        "Naive": f"SELECT series_key, month, h, last_y AS yhat FROM {p}ahead",
        "Drift": f"SELECT series_key, month, h, last_y + h * (last_y - first_y) / (n - 1) AS yhat FROM {p}ahead",
        "Seasonal Naive": f"SELECT a.series_key, a.month, h, y AS yhat {back} AND t.t = n + h - 12",
        "MA(3)": f"SELECT a.series_key, a.month, h, avg(y) AS yhat {back} AND t.t > n - 3 GROUP BY ALL",
        "MA(6)": f"SELECT a.series_key, a.month, h, avg(y) AS yhat {back} AND t.t > n - 6 GROUP BY ALL",
        "TSLM": f"""SELECT a.series_key, a.month, h, ys + b * (n + h - ts) AS yhat
            FROM {p}ahead a JOIN {p}slope l ON l.series_key = a.series_key
            JOIN {p}season z ON z.series_key = a.series_key AND z.s = (n + h) % 12""",
        "ETS": f"""SELECT series_key, CAST(last_month + h * INTERVAL 1 MONTH AS DATE) AS month,
            CAST(h AS INTEGER) AS h, l + h * b + s[h] AS yhat FROM {p}ets, range(1, 7) r(h)""",
        "AR": f"SELECT series_key, month, h, yhat FROM {p}ar_ahead",
        "Harmonic": f"""SELECT f.series_key, CAST(last_month + (r - f.n) * INTERVAL 1 MONTH AS DATE) AS month,
            CAST(r - f.n AS INTEGER) AS h, yhat
            FROM {p}fit f JOIN {p}ends e ON e.series_key = f.series_key WHERE r > f.n""",
    }
    return " UNION ALL ".join(
        f"SELECT series_key, '{m}' AS model, month, h, yhat FROM ({per_model[m]})" for m in models
    )


def _model_query(name, models, steps):
    @query(
        name,
        f"""{SERIES_SQL}, {steps}
        SELECT series_key, model, month, h, {q('yhat', 2)} AS yhat
        FROM ({_forecasts_sql(models)})""",
    )
    def run(spark, sf_dir):
        return show(fc.forecast(train(spark, sf_dir), models), 2)

    return run


for _name, _models in (
    ("fc_mean", ("Mean",)), ("fc_naive", ("Naive",)), ("fc_drift", ("Drift",)),
    ("fc_seasonal_naive", ("Seasonal Naive",)), ("fc_ma3_ma6", ("MA(3)", "MA(6)")), ("fc_tslm", ("TSLM",)),
):
    _model_query(_name, _models, _closed_sql("train"))
_model_query("fc_ets", ("ETS",), _ets_sql("train"))
_model_query("fc_ar", ("AR",), _ar_sql("train"))
_model_query("union_models", fc.STATISTICAL, _models_sql("train"))


@query(
    "fc_harmonic",
    f"""{SERIES_SQL}, {_harmonic_sql("train")}
    SELECT fit.series_key, 'Harmonic' AS model,
        CAST(last_month + (r - fit.n) * INTERVAL 1 MONTH AS DATE) AS month,
        CAST(r - fit.n AS INTEGER) AS h, {q('yhat', 2)} AS yhat
    FROM fit JOIN ends USING (series_key)""",
)
def fc_harmonic(spark, sf_dir):
    return show(fc.forecast_harmonic(train(spark, sf_dir)), 2)


# --- scores ---------------------------------------------------------------------

SCORES_SQL = f"""{SERIES_SQL}, {_models_sql("train")},
    forecasts AS ({_forecasts_sql(fc.STATISTICAL)}),
    scale AS (
        SELECT a.series_key, avg(abs(a.y - p.y)) AS scale FROM train a JOIN train p
            ON p.series_key = a.series_key AND p.t = a.t - 12 GROUP BY 1),
    scores AS (
        SELECT f.series_key, model, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) ^ 2)) AS rmse,
            avg(CASE WHEN y <> 0 THEN 100 * abs((y - yhat) / y) END) AS mape,
            count(CASE WHEN y = 0 THEN 1 END) AS zero_months
        FROM forecasts f JOIN test ON test.series_key = f.series_key AND test.month = f.month
        GROUP BY 1, 2)"""


def _scored(everything):
    learn, hold = ts.part(everything, "train"), ts.part(everything, "test")
    return fc.accuracy(fc.forecast(learn, fc.STATISTICAL), hold, learn)


@query(
    "fc_accuracy",
    f"""{SCORES_SQL}
    SELECT series_key, model, {q('mae', 2)} AS mae, {q('rmse', 2)} AS rmse, {q('mape', 4)} AS mape,
        zero_months, {q('mae / scale', 4)} AS mase
    FROM scores JOIN scale USING (series_key)""",
)
def fc_accuracy(spark, sf_dir):
    scores = _scored(pinned_parts(spark, sf_dir))
    return scores.select(
        "series_key", "model", rounded("mae", 2).alias("mae"), rounded("rmse", 2).alias("rmse"),
        rounded("mape").alias("mape"), "zero_months", rounded("mase").alias("mase"),
    )


BEST_SQL = f"""{SCORES_SQL},
    best AS (
        SELECT series_key, model, rmse FROM (
            SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY rmse, model) AS n FROM scores)
        WHERE n = 1)"""


@query("fc_best", f"{BEST_SQL} SELECT series_key, model, {q('rmse', 2)} AS rmse FROM best")
def fc_best(spark, sf_dir):
    return show(fc.best_model(_scored(pinned_parts(spark, sf_dir))), 2)


@query(
    "fc_compare",
    f"""{SCORES_SQL}
    SELECT series_key, month, 'actual' AS source, {q('y', 2)} AS value FROM test
    UNION ALL
    SELECT series_key, month, model, {q('yhat', 2)} FROM forecasts""",
)
def fc_compare(spark, sf_dir):
    everything = pinned_parts(spark, sf_dir)
    forecasts = fc.forecast(ts.part(everything, "train"), fc.STATISTICAL)
    return show(fc.compare(forecasts, ts.part(everything, "test")), 2)


@query(
    "fc_compare_best",
    f"""{BEST_SQL}
    SELECT series_key, month, 'actual' AS source, {q('y', 2)} AS value FROM test
    UNION ALL
    SELECT f.series_key, month, model, {q('yhat', 2)}
    FROM forecasts f JOIN best USING (series_key, model)""",
)
def fc_compare_best(spark, sf_dir):
    everything = pinned_parts(spark, sf_dir)
    learn, hold = ts.part(everything, "train"), ts.part(everything, "test")
    forecasts = fc.forecast(learn, fc.STATISTICAL)
    best = fc.best_model(fc.accuracy(forecasts, hold, learn))
    chosen = forecasts.join(best.select("series_key", "model"), ["series_key", "model"])
    return show(fc.compare(chosen, hold), 2)


# The full history plays the training set, whatever its length.
FULL_SQL = f"""{BEST_SQL},
    full_t AS (SELECT series_key, month, y, i AS t FROM series),
    full_ends AS (
        SELECT series_key, max(month) AS last_month, count(*) AS n, avg(y) AS mean_y,
            arg_max(y, month) AS last_y, arg_min(y, month) AS first_y FROM full_t GROUP BY 1),
    full_ahead AS (
        SELECT e.*, CAST(h AS INTEGER) AS h, CAST(last_month + h * INTERVAL 1 MONTH AS DATE) AS month
        FROM full_ends e, range(1, 7) r(h)),
    {_models_sql("full_t", "full_")},
    full_forecasts AS ({_forecasts_sql(fc.STATISTICAL, "full_t", "full_")})"""


@query(
    "fc_future",
    f"""{FULL_SQL}
    SELECT f.series_key, model, f.month, {q('yhat', 2)} AS yhat
    FROM full_forecasts f JOIN best USING (series_key, model)""",
)
def fc_future(spark, sf_dir):
    everything = pinned_parts(spark, sf_dir)
    best = fc.best_model(_scored(everything))
    return show(fc.future(everything.select("series_key", "month", "y"), best, fc.STATISTICAL), 2)


@query(
    "fc_future_all",
    f"{FULL_SQL} SELECT series_key, model, month, h, {q('yhat', 2)} AS yhat FROM full_forecasts",
)
def fc_future_all(spark, sf_dir):
    """Every model on the full history, so that each refit is checked, not only the best one's."""
    return show(fc.forecast(panel(spark, sf_dir), fc.STATISTICAL), 2)


FITTED_SQL = f"""{SERIES_SQL}, {_models_sql("train")},
    fitted AS (
        SELECT t.series_key, t.month, t.t, t.y, mean_y AS f1, lag(y) OVER w AS f2,
            lag(y) OVER w + (last_y - first_y) / (n - 1) AS f3, lag(y, 12) OVER w AS f4,
            ys + b * (t.t - ts) AS f5,
            c + phi * lag(y) OVER w AS g0,
            lag(y) OVER w + c + phi * (lag(y) OVER w - lag(y, 2) OVER w) AS g1,
            lag(y, 12) OVER w + c + phi * (lag(y) OVER w - lag(y, 13) OVER w) AS g12, d
        FROM train t JOIN ends USING (series_key) JOIN slope USING (series_key) JOIN ar USING (series_key)
        JOIN season ON season.series_key = t.series_key AND s = t.t % 12
        WINDOW w AS (PARTITION BY t.series_key ORDER BY t.month)),
    fits AS (
        SELECT series_key, 'Mean' AS model, month, y, f1 AS fitted FROM fitted
        UNION ALL SELECT series_key, 'Naive', month, y, f2 FROM fitted
        UNION ALL SELECT series_key, 'Drift', month, y, f3 FROM fitted
        UNION ALL SELECT series_key, 'Seasonal Naive', month, y, f4 FROM fitted
        UNION ALL SELECT series_key, 'MA(3)', month, y, y FROM fitted
        UNION ALL SELECT series_key, 'MA(6)', month, y, y FROM fitted
        UNION ALL SELECT series_key, 'TSLM', month, y, f5 FROM fitted
        UNION ALL SELECT f.series_key, 'ETS', month, y, fits[f.t] FROM fitted f JOIN ets e ON e.series_key = f.series_key
        UNION ALL SELECT series_key, 'AR', month, y, CASE d WHEN 0 THEN g0 WHEN 1 THEN g1 ELSE g12 END FROM fitted
        UNION ALL SELECT f.series_key, 'Harmonic', month, y, yhat FROM fitted f
            JOIN fit ON fit.series_key = f.series_key AND fit.r = f.t)"""


@query(
    "fc_residuals",
    f"""{FITTED_SQL}
    SELECT series_key, model, month, {q('y', 2)} AS y, {q('fitted', 2)} AS fitted,
        CASE WHEN model NOT LIKE 'MA%' THEN {q('y - fitted', 2)} END AS residual
    FROM fits""",
)
def fc_residuals(spark, sf_dir):
    return show(fc.residuals(train(spark, sf_dir), fc.STATISTICAL), 2)


_SHOCKS = "coalesce(list_sum(list_transform(range(1, f.h), lambda j: ({0}) ^ 2)), 0)"

INTERVAL_SQL = f"""{FITTED_SQL},
    forecasts AS ({_forecasts_sql(fc.STATISTICAL)}),
    spread AS (SELECT series_key, model, sum((y - fitted) ^ 2) AS sse FROM fits GROUP BY 1, 2),
    half AS (
        SELECT f.*, CASE f.model
            WHEN 'Mean' THEN {fc.Z80}e0 * sqrt(z.sse / (n - 1)) * sqrt(1 + 1e0 / n)
            WHEN 'Naive' THEN {fc.Z80}e0 * sqrt(z.sse / (n - 1)) * sqrt(f.h)
            WHEN 'Drift' THEN {fc.Z80}e0 * sqrt(z.sse / (n - 2)) * sqrt(f.h * (1 + f.h / (n - 1e0)))
            WHEN 'Seasonal Naive' THEN {fc.Z80}e0 * sqrt(z.sse / (n - 12)) * sqrt(floor((f.h - 1) / 12) + 1)
            WHEN 'TSLM' THEN {{t90}}e0 * sqrt(z.sse / (n - 13))
                * sqrt(1 + 1e0 / cnt + (n + f.h - ts) * (n + f.h - ts) / den)
            WHEN 'ETS' THEN {fc.Z80}e0 * sqrt(e.sse / nullif(greatest(n - e.k, 0), 0)) * sqrt(1 + {_SHOCKS.format(
                'e.a + j * e.wb + CASE WHEN j % 12 = 0 THEN e.g ELSE 0 END')})
            WHEN 'AR' THEN {fc.Z80}e0 * sqrt(r.sse / nullif(greatest(r.free, 0), 0)) * sqrt(1 + {_SHOCKS.format(
                'CASE r.d WHEN 1 THEN (1 - pow(r.phi, j + 1)) / (1 - r.phi) ELSE pow(r.phi, j) END')})
            END AS w
        FROM forecasts f JOIN spread z ON z.series_key = f.series_key AND z.model = f.model
        JOIN (SELECT series_key, n FROM ends) x ON x.series_key = f.series_key
        JOIN season s ON s.series_key = f.series_key AND s.s = (n + f.h) % 12
        JOIN slope l ON l.series_key = f.series_key
        JOIN (SELECT series_key, a, wb, g, k, sse FROM ets) e ON e.series_key = f.series_key
        JOIN ar r ON r.series_key = f.series_key)""".replace("{t90}", repr(t90_table()[18 - 13 - 1]))


@query(
    "fc_interval",
    f"""{INTERVAL_SQL},
    scores AS (
        SELECT f.series_key, model, sqrt(avg((y - yhat) ^ 2)) AS rmse
        FROM forecasts f JOIN test ON test.series_key = f.series_key AND test.month = f.month
        GROUP BY 1, 2),
    best AS (
        SELECT series_key, model FROM (SELECT *, row_number() OVER (
            PARTITION BY series_key ORDER BY rmse, model) AS n FROM scores) WHERE n = 1)
    SELECT half.series_key, model, half.month, {q('yhat', 2)} AS yhat, {q('yhat - w', 2)} AS lo80,
        {q('yhat + w', 2)} AS hi80, {q('y', 2)} AS actual
    FROM half JOIN best USING (series_key, model)
    JOIN test ON test.series_key = half.series_key AND test.month = half.month""",
)
def fc_interval(spark, sf_dir):
    everything = pinned_parts(spark, sf_dir)
    learn, hold = ts.part(everything, "train"), ts.part(everything, "test")
    banded = fc.intervals(learn, fc.STATISTICAL)
    best = fc.best_model(fc.accuracy(banded.select("series_key", "model", "month", "yhat"), hold, learn))
    return show(
        banded.join(best.select("series_key", "model"), ["series_key", "model"]).join(
            hold.withColumnRenamed("y", "actual"), ["series_key", "month"]
        ),
        2,
    )


@query(
    "fc_interval_all",
    f"""{INTERVAL_SQL}
    SELECT series_key, model, month, {q('yhat', 2)} AS yhat, {q('yhat - w', 2)} AS lo80,
        {q('yhat + w', 2)} AS hi80 FROM half""",
)
def fc_interval_all(spark, sf_dir):
    """The bounds of every model, not only of each series' best."""
    return show(fc.intervals(train(spark, sf_dir), fc.STATISTICAL), 2)


# --- boosted trees ----------------------------------------------------------------


@query("fc_gbt_depthwise")
def fc_gbt_depthwise(spark, sf_dir):
    everything = pinned_parts(spark, sf_dir)
    return show(fc.forecast_boosted(everything, "GBT depthwise", depth=4, leak_free=False), 2)


@query("fc_gbt_small")
def fc_gbt_small(spark, sf_dir):
    everything = pinned_parts(spark, sf_dir)
    return show(
        fc.forecast_boosted(everything, "GBT small", depth=3, min_leaf=20, leak_free=False), 2
    )


@query("fc_recursive")
def fc_recursive(spark, sf_dir):
    everything = pinned_parts(spark, sf_dir)
    return show(fc.forecast_boosted(everything, "GBT small", depth=3, min_leaf=20), 2)


@query(
    "boosted_check",
    f"""{SERIES_SQL}
    SELECT model, series_key, month, TRUE AS forecast, TRUE AS beats_mean
    FROM test, (SELECT unnest(['GBT depthwise', 'GBT small']) AS model)""",
)
def boosted_check(spark, sf_dir):
    """Each test month of each series has a forecast, and the trees beat the mean on the rows they learned."""
    everything = pinned_parts(spark, sf_dir)
    rows = pinned(fc.boosted_features(everything))
    learned = rows.filter(F.col("part") == "train")
    out = None
    for name, (depth, leaf) in fc.BOOSTED.items():
        model = fc.fit_boosted(rows, depth, leaf)
        errors = fc.predict_rows(model, learned, name).join(learned, ["series_key", "month"]).agg(
            F.avg((F.col("yhat") / F.col("scale") - F.col("target")) ** 2).alias("left"),
            F.var_pop("target").alias("around"),
        )
        beats = errors.select(F.col("left") < F.col("around")).scalar()
        history = everything.filter(F.col("part").isin("skip", "train")).select("series_key", "month", "y")
        scale = rows.select("series_key", "scale").distinct()
        ahead = fc.predict_recursive(model, history, scale, name)
        row = ahead.select(
            "model", "series_key", "month", F.col("yhat").isNotNull().alias("forecast"), beats.alias("beats_mean")
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("fc_all_models")
def fc_all_models(spark, sf_dir):
    """Forecasts, residuals, scores and futures of all twelve models as one long table."""
    return show(_all_long(fc.all_models(pinned_parts(spark, sf_dir))), 2)


def _all_long(found: fc.AllModels) -> DataFrame:
    """``(kind, series_key, model, month, value)`` with the rank of each model by RMSE."""
    place = F.row_number().over(Window.partitionBy("series_key").orderBy("rmse", "model"))
    parts = {
        "forecast": found.forecasts.withColumnRenamed("yhat", "value"),
        "residual": found.residuals.withColumnRenamed("residual", "value"),
        "future": found.future.withColumnRenamed("yhat", "value"),
        "rmse": found.scores.withColumn("month", F.lit(None).cast("date")).withColumnRenamed("rmse", "value"),
        "rank": found.scores.withColumn("value", place.cast("double")).withColumn("month", F.lit(None).cast("date")),
    }
    tables = [t.select(F.lit(kind).alias("kind"), "series_key", "model", "month", "value") for kind, t in parts.items()]
    return reduce(DataFrame.unionByName, tables)


@query(
    "fc_all_models_check",
    f"""{SCORES_SQL},
    least AS (SELECT series_key, min(rmse) AS rmse FROM scores GROUP BY 1),
    models AS (SELECT DISTINCT model FROM scores UNION ALL SELECT unnest(['GBT depthwise', 'GBT small']))
    SELECT l.series_key, m.model, CAST(6 AS BIGINT) AS months,
        CASE WHEN m.model LIKE 'MA(%' THEN 0 WHEN m.model IN ('Naive', 'Drift') THEN n - 1
            WHEN m.model = 'Seasonal Naive' THEN n - 12 WHEN m.model = 'AR' THEN NULL ELSE n END AS residuals,
        {q('s.rmse', 2)} AS rmse, {q('l.rmse', 2)} AS best_statistical, TRUE AS best_is_least, TRUE AS ranked,
        CAST(6 AS BIGINT) AS months_ahead
    FROM least l CROSS JOIN models m JOIN (SELECT series_key, n FROM ends) e ON e.series_key = l.series_key
    LEFT JOIN scores s ON s.series_key = l.series_key AND s.model = m.model""",
)
def fc_all_models_check(spark, sf_dir):
    """What is certain about twelve models: who has forecasts, residuals and scores, who is ranked and chosen."""
    found = fc.all_models(pinned_parts(spark, sf_dir))
    long = pinned(_all_long(found))
    boosted = F.col("model").isin(*fc.BOOSTED)
    of = lambda kind: F.when(F.col("kind") == kind, F.col("value"))
    per_model = long.filter("kind <> 'future'").groupBy("series_key", "model").agg(
        F.count(of("forecast")).alias("months"), F.count(of("residual")).alias("residuals"),
        F.max(of("rmse")).alias("_rmse"), F.max(of("rank")).alias("_rank"),
    )
    ahead = found.future.groupBy("series_key", F.col("model").alias("_chosen")).agg(F.count("yhat").alias("months_ahead"))
    whole = Window.partitionBy("series_key")
    by_rank = whole.orderBy("_rank")
    rows = per_model.join(ahead, "series_key", "left").withColumns(
        {
            "best_statistical": rounded(F.min(F.when(~boosted, F.col("_rmse"))).over(whole), 2),
            "_first": F.min_by("model", "_rank").over(whole),
            "ranked": F.coalesce(F.col("_rmse") >= F.lag("_rmse").over(by_rank), F.col("_rank") == 1),
            "_least": F.min("_rmse").over(whole),
        }
    )
    return rows.select(
        "series_key", "model", "months", F.when(F.col("model") != "AR", F.col("residuals")).alias("residuals"),
        F.when(~boosted, rounded("_rmse", 2)).alias("rmse"), "best_statistical",
        ((F.col("_first") == F.col("_chosen")) & F.when(F.col("_rank") == 1, F.col("_rmse") == F.col("_least")).otherwise(True)).alias("best_is_least"),
        "ranked", "months_ahead",
    )


# --- diagnostics ------------------------------------------------------------------


def _loess_sql(degree):
    if degree == 1:
        det, own = "(s0 * s2 - s1 * s1)", "s2"
        effect = "w * (s2 - s1 * d) / (s0 * s2 - s1 * s1)"
    else:
        own = "(s2 * s4 - s3 * s3)"
        det = "(s0 * (s2 * s4 - s3 * s3) + s1 * (s2 * s3 - s1 * s4) + s2 * (s1 * s3 - s2 * s2))"
        effect = f"w * ({own} + (s2 * s3 - s1 * s4) * d + (s1 * s3 - s2 * s2) * d * d) / {det}"
    return f"""{SERIES_SQL},
    size AS (SELECT series_key, count(*) AS n, CAST(floor(0.3 * count(*)) AS BIGINT) AS k
        FROM series GROUP BY 1),
    dist AS (
        SELECT a.series_key, a.month, a.y AS y0, b.y, b.i - a.i AS d, n, k,
            row_number() OVER (PARTITION BY a.series_key, a.i ORDER BY abs(b.i - a.i)) AS r
        FROM series a JOIN series b ON a.series_key = b.series_key JOIN size s ON s.series_key = a.series_key),
    wide AS (SELECT *, max(CASE WHEN r = k THEN abs(d) END) OVER (PARTITION BY series_key, month) AS width
        FROM dist),
    weighted AS (SELECT *, CASE WHEN abs(d) < width THEN pow(1 - pow(abs(d) / width, 3), 3) ELSE 0e0 END AS w
        FROM wide),
    moments AS (
        SELECT *, {', '.join(f"sum(w * pow(d, {k})) OVER (PARTITION BY series_key, month) AS s{k}" for k in range(5))}
        FROM weighted),
    fit AS (
        SELECT series_key, month, max(y0) AS y, max(n) AS n, sum({effect} * y) AS trend,
            sum(({effect}) ^ 2) AS ll, max({own} / {det}) AS own
        FROM moments GROUP BY 1, 2),
    banded AS (
        SELECT *, 1.959963984540054e0 * sqrt(sum((y - trend) ^ 2) OVER p
            / (n - 2 * sum(own) OVER p + sum(ll) OVER p) * ll) AS half
        FROM fit WINDOW p AS (PARTITION BY series_key))
    SELECT series_key, month, {q('y', 2)} AS y, {q('trend', 2)} AS trend,
        {q('trend - half', 2)} AS lower, {q('trend + half', 2)} AS upper
    FROM banded"""


@query("ts_local_trend", _loess_sql(1))
def ts_local_trend(spark, sf_dir):
    return show(ts.local_trend(panel(spark, sf_dir)), 2)


@query("ts_local_trend_quadratic", _loess_sql(2))
def ts_local_trend_quadratic(spark, sf_dir):
    return show(ts.local_trend(panel(spark, sf_dir), degree=2), 2)


@query(
    "ts_decompose",
    f"""{SERIES_SQL},
    tr AS (
        SELECT *, CASE WHEN count(y) OVER (w ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13
            THEN (avg(y) OVER (w ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
                + avg(y) OVER (w ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2 END AS trend
        FROM series WINDOW w AS (PARTITION BY series_key ORDER BY month)),
    se AS (
        SELECT series_key, month(month) AS mm, avg(y - trend) AS raw FROM tr GROUP BY 1, 2),
    ce AS (SELECT *, raw - avg(raw) OVER (PARTITION BY series_key) AS seasonal FROM se)
    SELECT tr.series_key, month, {q('y', 2)} AS y, {q('trend', 2)} AS trend,
        {q('seasonal', 2)} AS seasonal, {q('y - trend - seasonal', 2)} AS remainder
    FROM tr JOIN ce ON ce.series_key = tr.series_key AND mm = month(month)""",
)
def ts_decompose(spark, sf_dir):
    return show(ts.decompose(panel(spark, sf_dir)), 2)


def _robust_sql(months, refits, rounds):
    """Each step of the robust decomposition as one stored table."""
    steps = [f"""
    base AS MATERIALIZED (SELECT series_key, month, i - 1 AS i, y, count(*) OVER (PARTITION BY series_key) AS n FROM series),
    reach AS (
        SELECT series_key, i, n, CASE WHEN least({months}, n) <= 2 * least(i, n - 1 - i) + 1 THEN least({months}, n) // 2
            ELSE least({months}, n) - 1 - least(i, n - 1 - i) END AS h FROM base),
    near AS MATERIALIZED (
        SELECT a.series_key, a.i, b.i AS j, b.i - a.i AS d, pow(1 - pow(abs(b.i - a.i) / (h + 1e0), 3), 3) AS w
        FROM reach a JOIN base b ON b.series_key = a.series_key AND abs(b.i - a.i) <= h),
    middle AS MATERIALIZED (
        SELECT *, median(y) OVER (PARTITION BY series_key ORDER BY i ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS t FROM base),
    season0 AS MATERIALIZED (
        SELECT series_key, m, raw - avg(raw) OVER (PARTITION BY series_key) AS s FROM (
            SELECT series_key, i % 12 AS m, median(y - t) AS raw FROM middle GROUP BY 1, 2)),
    left0 AS MATERIALIZED (
        SELECT b.series_key, b.i, y - s AS v, t FROM middle b JOIN season0 z ON z.series_key = b.series_key AND z.m = b.i % 12),
    rho0 AS MATERIALIZED (
        SELECT series_key, i, pow(1 - pow(least(abs(v - t) / med, 1), 2), 2) AS rho FROM (
            SELECT *, 6 * quantile_cont(abs(v - t), 0.5) OVER (PARTITION BY series_key) AS med FROM left0))"""]

    def line(name, values, rho):
        return f"""
    {name} AS MATERIALIZED (
        SELECT series_key, i, (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) AS trend FROM (
            SELECT x.series_key, x.i, sum(w * rho) AS s0, sum(w * rho * d) AS s1, sum(w * rho * d * d) AS s2,
                sum(w * rho * v) AS t0, sum(w * rho * d * v) AS t1
            FROM near x JOIN {values} v ON v.series_key = x.series_key AND v.i = x.j
            JOIN {rho} r ON r.series_key = x.series_key AND r.i = x.j GROUP BY 1, 2))"""

    steps.append(line("trend0", "left0", "rho0"))
    count, rho = 0, "rho0"
    for k in range(rounds + 1):
        for _ in range(refits):
            before, count = f"trend{count}", count + 1
            steps.append(f"""
    season{count} AS MATERIALIZED (
        SELECT series_key, m, raw - avg(raw) OVER (PARTITION BY series_key) AS s FROM (
            SELECT b.series_key, b.i % 12 AS m, coalesce(sum(rho * (y - trend)) / nullif(sum(rho), 0), median(y - trend)) AS raw
            FROM base b JOIN {before} t ON t.series_key = b.series_key AND t.i = b.i
            JOIN {rho} r ON r.series_key = b.series_key AND r.i = b.i GROUP BY 1, 2)),
    left{count} AS MATERIALIZED (
        SELECT b.series_key, b.i, y - s AS v FROM base b JOIN season{count} z ON z.series_key = b.series_key AND z.m = b.i % 12)""")
            steps.append(line(f"trend{count}", f"left{count}", rho))
        if k < rounds:
            steps.append(f"""
    rho{k + 1} AS MATERIALIZED (
        SELECT series_key, i, pow(1 - pow(least(r / med, 1), 2), 2) AS rho FROM (
            SELECT *, 6 * quantile_cont(r, 0.5) OVER (PARTITION BY series_key) AS med FROM (
                SELECT v.series_key, v.i, abs(v - trend) AS r FROM left{count} v
                JOIN trend{count} t ON t.series_key = v.series_key AND t.i = v.i)))""")
            rho = f"rho{k + 1}"
    return ",".join(steps) + f""",
    done AS (
        SELECT b.series_key, month, y, trend, s AS seasonal, y - trend - s AS remainder, rho AS weight
        FROM base b JOIN trend{count} t ON t.series_key = b.series_key AND t.i = b.i
        JOIN season{count} z ON z.series_key = b.series_key AND z.m = b.i % 12
        JOIN {rho} r ON r.series_key = b.series_key AND r.i = b.i)"""


@query(
    "ts_robust_decompose",
    f"""{SERIES_SQL}, {_robust_sql(ts.TREND_MONTHS, ts.REFITS, ts.ROBUST_ROUNDS)}
    SELECT series_key, month, {q('y', 1)} AS y, {q('trend', 1)} AS trend, {q('seasonal', 1)} AS seasonal,
        {q('remainder', 1)} AS remainder, {q('weight', 6)} AS weight FROM done""",
)
def ts_robust_decompose(spark, sf_dir):
    found = ts.robust_decompose(panel(spark, sf_dir))
    names = ("y", "trend", "seasonal", "remainder")
    return found.select("series_key", "month", *[rounded(c, 1).alias(c) for c in names], rounded("weight", 6).alias("weight"))


ACF_SQL = f"""{SERIES_SQL},
    c AS (SELECT series_key, i, y - avg(y) OVER (PARTITION BY series_key) AS z FROM series),
    r AS (
        SELECT a.series_key, CAST(b.i - a.i AS INTEGER) AS lag, sum(a.z * b.z) AS num
        FROM c a JOIN c b ON a.series_key = b.series_key AND b.i - a.i BETWEEN 1 AND 24 GROUP BY 1, 2),
    acf AS (
        SELECT r.series_key, lag, num / den AS acf
        FROM r JOIN (SELECT series_key, sum(z * z) AS den FROM c GROUP BY 1) USING (series_key))"""


@query("ts_acf", f"{ACF_SQL} SELECT series_key, lag, {q('acf', 6)} AS acf FROM acf")
def ts_acf(spark, sf_dir):
    return show(ts.acf(panel(spark, sf_dir)), 6)


@query(
    "ts_pacf",
    f"""{ACF_SQL},
    lists AS (SELECT series_key, list(acf ORDER BY lag) AS r FROM acf GROUP BY 1),
    walk AS (
        WITH RECURSIVE w AS (
            SELECT series_key, r, CAST(1 AS BIGINT) AS k, [r[1]] AS phi FROM lists
            UNION ALL
            SELECT series_key, r, k + 1,
                list_append(list_transform(range(1, k + 1), lambda j: phi[j] - kk * phi[k + 1 - j]), kk)
            FROM (SELECT *, (r[k + 1] - list_sum(list_transform(range(1, k + 1),
                        lambda j: phi[j] * r[k + 1 - j])))
                    / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j]))) AS kk
                  FROM w WHERE k < len(r)))
        SELECT * FROM w)
    SELECT series_key, CAST(k AS INTEGER) AS lag, {q('phi[k]', 6)} AS pacf FROM walk""",
)
def ts_pacf(spark, sf_dir):
    return show(ts.pacf(panel(spark, sf_dir)), 6)

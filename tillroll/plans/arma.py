"""Seasonal ARMA models next to their SQL."""

from __future__ import annotations

from tillroll.functions.columns import rounded
from tillroll.operators import arma
from tillroll.plans.common import show
from tillroll.plans.registry import q, query
from tillroll.plans.series import SERIES_SQL, _closed_sql, panel


def _solve_sql(name: str, source: str, keys: str, size: int) -> str:
    """Gauss-Jordan elimination of ``size`` equations in the column ``m``, one step each; the solution is ``beta``."""
    steps = []
    for j in range(1, size + 1):
        before = source if j == 1 else f"{name}{j - 1}"
        steps.append(f"""
    {name}{j} AS (
        SELECT {keys}, list_transform(range(1, {size + 1}), lambda i: CASE WHEN i = {j} THEN p ELSE
            list_transform(range(1, {size + 2}), lambda c: m[i][c] - m[i][{j}] * p[c]) END) AS m
        FROM (SELECT {keys}, m, list_transform(m[{j}], lambda v: v / m[{j}][{j}]) AS p FROM {before}))""")
    return ",".join(steps) + f""",
    {name} AS (SELECT {keys}, list_transform(m, lambda r: r[{size + 1}]) AS beta FROM {name}{size})"""


def _sums_sql(columns: list[str]) -> str:
    rows = ", ".join("[" + ", ".join(f"sum(({a}) * ({b}))" for b in columns) + "]" for a in columns)
    return f"[{rows}]"


_LONG = ["1e0", *(f"x[t - {k}]" for k in arma.LONG_WIDE), "x[t]"]
_ROW = ["1e0", *(f"{v}[t - {k}]" for v in "xe" for k in arma.LAGS), "x[t]"]
_ORDERS = ", ".join(
    f"({i}, {p}, {o}, {sp}, {sq}, {arma.mask_of((p, o, sp, sq))})" for i, (p, o, sp, sq) in enumerate(arma.ORDERS)
)
_BETA = len(_ROW) - 1

# For series that have enough months for seasonal terms.
ARMA_SQL = f"""{SERIES_SQL},
    full_t AS (SELECT series_key, month, y, i AS t FROM series),
    {_closed_sql("full_t")},
    hist AS (SELECT series_key, max(month) AS last_month, list(y ORDER BY t) AS ys, count(*) AS n, avg(y) AS my, avg(t) AS mt
        FROM full_t GROUP BY 1),
    strength AS (
        SELECT x.series_key, 1 - sum((y - (ys + b * (t - ts))) ^ 2) / sum((y - my - b * (t - mt)) ^ 2) AS f
        FROM full_t x JOIN (SELECT series_key, my, mt FROM hist) h ON h.series_key = x.series_key
        JOIN season z ON z.series_key = x.series_key AND z.s = x.t % 12 JOIN slope l ON l.series_key = x.series_key GROUP BY 1),
    seasonal AS (
        SELECT h.series_key, last_month, ys, CASE WHEN n >= {arma.SEASON_MONTHS} AND f > {arma.STRENGTH} THEN 1 ELSE 0 END AS sd,
            CASE WHEN n >= {arma.SEASON_MONTHS} AND f > {arma.STRENGTH}
                THEN list_transform(range(13, n + 1), lambda i: ys[i] - ys[i - 12]) ELSE ys END AS z
        FROM hist h JOIN strength s ON s.series_key = h.series_key),
    centred AS (
        SELECT *, len(z) AS m, list_transform(z, lambda v: v - list_avg(z)) AS c,
            CAST(floor(3 * sqrt(len(z)) / 13) AS BIGINT) AS lag FROM seasonal),
    tested AS (
        SELECT *, list_sum(list_transform(range(1, m + 1), lambda i: list_sum(c[1:i]) ^ 2)) / (m * m * (
            list_sum(list_transform(c, lambda v: v * v)) + 2 * coalesce(list_sum(list_transform(range(1, lag + 1), lambda j:
                (1 - j / (lag + 1e0)) * list_sum(list_transform(range(1, m - j + 1), lambda i: c[i] * c[i + j])))), 0)) / m) AS level
        FROM centred),
    stationary AS (
        SELECT *, CASE WHEN level > {arma.LEVEL_TEST} THEN 1 ELSE 0 END AS d, CASE WHEN level > {arma.LEVEL_TEST}
            THEN list_transform(range(2, m + 1), lambda i: z[i] - z[i - 1]) ELSE z END AS u FROM tested),
    scaled AS (
        SELECT series_key, last_month, ys, sd, d, len(u) AS nx, sqrt(list_avg(list_transform(u, lambda v: v * v))) AS scale,
            list_transform(u, lambda v: v / sqrt(list_avg(list_transform(u, lambda w: w * w)))) AS x FROM stationary),
    long0 AS (
        SELECT series_key, {_sums_sql(_LONG)} AS m
        FROM (SELECT series_key, x, unnest(range({arma.LONG_WIDE[-1] + 1}, nx + 1)) AS t FROM scaled) GROUP BY 1),
    {_solve_sql("long", "long0", "series_key", len(_LONG) - 1)},
    shocked AS (
        SELECT s.*, list_transform(range(1, nx + 1), lambda t: CASE WHEN t > {arma.LONG_WIDE[-1]} THEN x[t] - (beta[1]
            + {" + ".join(f"beta[{i}] * x[t - {k}]" for i, k in enumerate(arma.LONG_WIDE, 2))}) ELSE 0e0 END) AS e
        FROM scaled s JOIN long l ON l.series_key = s.series_key),
    equations AS (
        SELECT series_key, {_sums_sql(_ROW)} AS g, count(*) AS cnt
        FROM (SELECT series_key, x, e, unnest(range({arma.FIRST_WIDE + 1}, nx + 1)) AS t FROM shocked) GROUP BY 1),
    orders(ord, p, q, sp, sq, mask) AS (VALUES {_ORDERS}),
    masks AS (
        SELECT s.series_key, ord, p, q, sp, sq, g, cnt, list_concat([CASE WHEN d + sd > 1 THEN 0e0 ELSE 1e0 END],
            list_transform(mask[2:{_BETA}], lambda v: CAST(v AS DOUBLE))) AS mask
        FROM equations e JOIN scaled s ON s.series_key = e.series_key, orders),
    fit0 AS (
        SELECT series_key, ord, list_transform(range(1, {_BETA + 1}), lambda i: list_transform(range(1, {_BETA + 2}), lambda j:
            CASE WHEN i = j AND mask[i] = 0 THEN 1e0 ELSE g[i][j] * mask[i] * coalesce(mask[j], 1e0) END)) AS m FROM masks),
    {_solve_sql("fit", "fit0", "series_key, ord", _BETA)},
    scored AS (
        SELECT k.*, beta, g[{_BETA + 1}][{_BETA + 1}] - list_sum(list_transform(range(1, {_BETA + 1}),
            lambda i: beta[i] * g[{_BETA + 1}][i])) AS sse, list_sum(mask) + 1 AS k
        FROM masks k JOIN fit f ON f.series_key = k.series_key AND f.ord = k.ord),
    ranked AS (
        SELECT *, cnt * ln(greatest(sse / cnt, 1e-12)) + 2 * k + 2 * k * (k + 1) / (cnt - k - 1) AS aicc FROM scored
        WHERE cnt - k - 1 > 0 AND abs(beta[2]) + beta[3] < 1 AND beta[3] > -1 AND abs(beta[4]) < 1),
    chosen AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY aicc, ord) AS place FROM ranked)
        WHERE place = 1)"""


@query(
    "arma_orders",
    f"""{ARMA_SQL}
    SELECT c.series_key, d, CAST(p AS INTEGER) AS p, CAST(q AS INTEGER) AS q, CAST(sp AS INTEGER) AS sp, CAST(sq AS INTEGER) AS sq,
        sd, {q('aicc', 3)} AS aicc, {q('sqrt(sse / cnt) * scale', 0)} AS sigma
    FROM chosen c JOIN scaled s ON s.series_key = c.series_key""",
)
def arma_orders(spark, sf_dir):
    found = arma.arma_orders(panel(spark, sf_dir))
    return show(found.withColumn("sigma", rounded("sigma", 0)), 3)


@query(
    "fc_arma",
    f"""{ARMA_SQL},
    walk AS (
        WITH RECURSIVE w AS (
            SELECT c.series_key, last_month, beta, d, sd, scale, 0 AS h, x, e, ys AS y
            FROM chosen c JOIN shocked s ON s.series_key = c.series_key
            UNION ALL
            SELECT series_key, last_month, beta, d, sd, scale, h + 1, list_append(x, v), list_append(e, 0e0),
                list_append(y, v * scale + CASE WHEN d = 1 THEN y[len(y)] ELSE 0 END + CASE WHEN sd = 1 THEN y[len(y) - 11] ELSE 0 END
                    - CASE WHEN d = 1 AND sd = 1 THEN y[len(y) - 12] ELSE 0 END)
            FROM (SELECT *, beta[1] + beta[2] * x[len(x)] + beta[3] * x[len(x) - 1] + beta[4] * x[len(x) - 11]
                + beta[5] * e[len(e)] + beta[6] * e[len(e) - 1] + beta[7] * e[len(e) - 11] AS v FROM w WHERE h < 6))
        SELECT series_key, CAST(last_month + h * INTERVAL 1 MONTH AS DATE) AS month, h, y[len(y)] AS yhat FROM w WHERE h > 0)
    SELECT series_key, 'ARMA' AS model, month, h, {q('yhat', 0)} AS yhat FROM walk""",
)
def fc_arma(spark, sf_dir):
    return show(arma.forecast_arma(panel(spark, sf_dir)), 0)

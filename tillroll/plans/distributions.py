"""Distribution tables behind the charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions import probability as pr
from tillroll.functions.columns import rounded
from tillroll.operators import cleaning, distribution, features, reports
from tillroll.plans.common import SEGMENT_SQL, fact, products_view, show
from tillroll.plans.registry import q, query
from tillroll.plans.reports import RATING_SQL, RFM_SQL, rfm_table
from tillroll.session import pinned
from tillroll.sources.star import load_star

FREQ_SQL = """
    per_customer AS (SELECT customer_id, count(*) AS freq FROM s_orders
        WHERE customer_id IS NOT NULL GROUP BY 1),
    freqs AS (SELECT freq, count(*) AS customers FROM per_customer GROUP BY 1)"""


def _hist_sql(chart, source, column, bins):
    return f"""
    SELECT '{chart}' AS chart, bin, {q('lo + bin * w')} AS low, {q('lo + (bin + 1) * w')} AS high, n,
        round(n / (sum(n) OVER () * w) + 1e-9, 7) AS density
    FROM (SELECT CAST(least(floor((x - lo) / w), bins - 1) AS BIGINT) AS bin, lo, w, count(*) AS n
        FROM (SELECT CAST({column} AS DOUBLE) AS x, lo, bins, (hi - lo) / bins AS w
            FROM {source}, (SELECT CAST(min({column}) AS DOUBLE) AS lo,
                CAST(max({column}) AS DOUBLE) AS hi, {bins} AS bins FROM {source}))
        WHERE x IS NOT NULL GROUP BY ALL)"""


@query(
    "histogram",
    f"""{FREQ_SQL},
    lp AS (SELECT final_price FROM s_fact WHERE final_price >= 0),
    ld AS (SELECT discount_rate_adjusted * 100 AS pct FROM s_lines
        WHERE discount_rate_adjusted * 100 BETWEEN 0 AND 100),
    pd AS (SELECT discount_rate FROM s_products WHERE discount_rate > 0),
    oa AS (SELECT total_amount FROM s_orders WHERE total_amount > 0)
    {_hist_sql('product_price', 's_products', 'final_price', 50)}
    UNION ALL {_hist_sql('line_price', 'lp', 'final_price', 60)}
    UNION ALL {_hist_sql('product_discount', 'pd', 'discount_rate', 30)}
    UNION ALL {_hist_sql('line_discount', 'ld', 'pct', 40)}
    UNION ALL {_hist_sql('order_amount', 'oa', 'total_amount', 60)}
    UNION ALL {_hist_sql('order_frequency', 'per_customer', 'freq',
                         'greatest(30, least(100, count(DISTINCT freq)))')}""",
)
def histogram(spark, sf_dir):
    star = load_star(spark, sf_dir)
    products, sold = star.products, pinned(cleaning.valid_price(products_view(star)))
    lines = star.lines.select(F.col("discount_rate_adjusted").alias("discount_rate"))
    freq = reports.order_frequency(star.orders)
    charts = {
        "product_price": distribution.histogram(products, "final_price", 50),
        "line_price": distribution.histogram(sold, "final_price", 60, "line_count"),
        "product_discount": distribution.histogram(cleaning.discounted(products), "discount_rate", 30),
        "line_discount": distribution.histogram(cleaning.valid_discount_pct(lines), "discount_pct", 40),
        "order_amount": distribution.histogram(cleaning.valid_amount(star.orders), "total_amount", 60),
        "order_frequency": distribution.histogram(
            freq, "freq",
            F.greatest(F.lit(30), F.least(F.lit(100), freq.agg(F.count(F.lit(1))).scalar())),
            "customers",
        ),
    }
    out = None
    for name, chart in charts.items():
        tagged = chart.withColumn("chart", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out.select(
        "chart", "bin", rounded("low").alias("low"), rounded("high").alias("high"), "n",
        F.round(F.col("density") + 1e-9, 7).alias("density"),
    )


def _density_sql(chart, source, column):
    return f"""
    SELECT '{chart}' AS chart, {q('lo + j * step', 2)} AS x, round(1e6 * d + 1e-7, 3) AS density_ppm
    FROM (
        SELECT any_value(lo) AS lo, j, any_value(step) AS step,
            sum(w * exp(-0.5 * ((j - k) * step / bw) ^ 2)) / (any_value(n) * any_value(bw) * sqrt(2 * pi())) AS d
        FROM (SELECT k, sum(w) AS w, any_value(lo) AS lo, any_value(step) AS step, any_value(n) AS n,
                any_value(bw) AS bw
            FROM (SELECT unnest([kk, kk + 1]) AS k, unnest([1 - (pos - kk), pos - kk]) AS w, lo, step, n, bw
                FROM (SELECT pos, least(floor(pos), 510) AS kk, lo, step, n, bw
                    FROM (SELECT ({column} - lo) / ((hi - lo) / 511) AS pos, lo, (hi - lo) / 511 AS step,
                            n, 0.9 * least(sd, iqr / 1.34) * pow(n, -0.2) AS bw
                        FROM {source}, (SELECT count({column}) AS n, min({column}) AS lo,
                            max({column}) AS hi, stddev_samp({column}) AS sd,
                            quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25) AS iqr
                            FROM {source}))))
            GROUP BY k), range(0, 512) g(j)
        GROUP BY j)"""


@query(
    "density",
    f"""
    lp AS (SELECT final_price FROM s_fact WHERE final_price >= 0),
    oa AS (SELECT total_amount FROM s_orders WHERE total_amount > 0)
    {_density_sql('line_price', 'lp', 'final_price')}
    UNION ALL {_density_sql('order_amount', 'oa', 'total_amount')}""",
)
def density(spark, sf_dir):
    star = load_star(spark, sf_dir)
    prices = distribution.density(
        cleaning.valid_price(products_view(star)), "final_price", weight="line_count"
    )
    amounts = distribution.density(cleaning.valid_amount(star.orders), "total_amount")
    both = prices.withColumn("chart", F.lit("line_price")).unionByName(
        amounts.withColumn("chart", F.lit("order_amount"))
    )
    return both.select(
        "chart", rounded("x", 2).alias("x"), rounded(F.col("density") * 1e6, 3).alias("density_ppm")
    )


BOX_SQL = f"""
    quart AS (
        SELECT chart, grp, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
            quantile_cont(v, 0.75) AS q3 FROM pool GROUP BY 1, 2),
    fenced AS (
        SELECT p.*, q1, median, q3, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
        FROM pool p JOIN quart USING (chart, grp))
    SELECT chart, grp, {q('q1', 2)} AS q1, {q('median', 2)} AS median, {q('q3', 2)} AS q3, count(*) AS n,
        {q('min(v)', 2)} AS min, {q('max(v)', 2)} AS max,
        {q('min(CASE WHEN inside THEN v END)', 2)} AS whisker_low,
        {q('max(CASE WHEN inside THEN v END)', 2)} AS whisker_high,
        count(*) FILTER (NOT inside) AS outliers
    FROM fenced GROUP BY chart, grp, q1, median, q3"""


@query(
    "box_stats",
    f"""{SEGMENT_SQL}, {RFM_SQL},
    pool AS (
        SELECT 'monetary' AS chart, customer_type AS grp, CAST(monetary AS DOUBLE) AS v FROM rfm
        UNION ALL SELECT 'order_count', customer_type, order_count FROM rfm
        UNION ALL SELECT 'recency_days', customer_type, recency_days FROM rfm
        UNION ALL SELECT 'price', root_category, final_price FROM s_products WHERE final_price <= 1000
        UNION ALL SELECT 'line_total', CAST(round(discount_rate_adjusted, 2) AS VARCHAR), line_total
            FROM s_lines WHERE discount_rate_adjusted IS NOT NULL),
    {BOX_SQL}""",
)
def box_stats(spark, sf_dir):
    star = load_star(spark, sf_dir)
    customers = rfm_table(star).filter(F.col("customer_type").isNotNull())
    measures = ("monetary", "order_count", "recency_days")
    pool = customers.select("customer_type", *[F.col(c).cast("double").alias(c) for c in measures])
    pool = pool.unpivot(["customer_type"], list(measures), "chart", "v").select(
        "chart", F.col("customer_type").alias("grp"), "v"
    )
    prices = cleaning.valid_price(star.products, at_most=1000).select(
        F.lit("price").alias("chart"), F.col("root_category").alias("grp"), F.col("final_price").alias("v")
    )
    totals = star.lines.filter(F.col("discount_rate_adjusted").isNotNull()).select(
        F.lit("line_total").alias("chart"),
        F.round("discount_rate_adjusted", 2).cast("string").alias("grp"),
        F.col("line_total").alias("v"),
    )
    return show(
        distribution.box_stats(pool.unionByName(prices).unionByName(totals), "v", ["chart", "grp"]), 2
    )


def _trend_sql(chart, source, x, y):
    return f"""
    SELECT '{chart}' AS chart, n, {q('slope')} AS slope, {q('intercept')} AS intercept, {q('r2')} AS r2,
        {q('mean_x')} AS mean_x, {q('sxx')} AS sxx, {q('se')} AS residual_se,
        {q('se / sqrt(sxx)')} AS slope_se
    FROM (SELECT *, sqrt(greatest((syy - slope * sxy) / (n - 2), 0)) AS se
        FROM (SELECT regr_count({y}, {x}) AS n, regr_slope({y}, {x}) AS slope,
            regr_intercept({y}, {x}) AS intercept, regr_r2({y}, {x}) AS r2, regr_avgx({y}, {x}) AS mean_x,
            regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy, regr_sxy({y}, {x}) AS sxy
            FROM {source}))"""


@query(
    "linear_trend",
    f"""{RATING_SQL},
    sold AS (SELECT product_id, sum(line_total) AS sales, max(image_count) AS image_count
        FROM s_fact GROUP BY 1),
    rated AS (SELECT * FROM sold JOIN prod_rated USING (product_id)),
    cheap AS (SELECT * FROM s_products WHERE discount_rate > 0)
    {_trend_sql('discount_by_price', 'cheap', 'initial_price', 'discount_rate')}
    UNION ALL {_trend_sql('sales_by_rating', 'rated', 'rating', 'sales')}
    UNION ALL {_trend_sql('sales_by_images', 'sold', 'image_count', 'sales')}""",
)
def linear_trend(spark, sf_dir):
    star = load_star(spark, sf_dir)
    sold = pinned(products_view(star).drop("rating"))
    rated = sold.join(
        features.product_rating(features.rated_products(sold)), "product_id", "left"
    )
    charts = {
        "discount_by_price": (cleaning.discounted(star.products), "initial_price", "discount_rate"),
        "sales_by_rating": (reports.rating_sales(rated), "rating", "sales"),
        "sales_by_images": (reports.content_richness(sold), "image_count", "sales"),
    }
    out = None
    for name, (df, x, y) in charts.items():
        row = distribution.linear_trend(df, x, y).withColumn("chart", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return show(out)


def _poly(x, coefficients, last=None):
    out = repr(coefficients[0])
    for c in (*coefficients[1:], *(() if last is None else (last,))):
        out = f"({out} * {x} + {c!r})"
    return out


def _tail(t):
    x = f"sqrt(-2 * ln({t}))"
    return f"{_poly(x, pr.C)} / {_poly(x, pr.D, 1.0)}"


NORMAL_SQL = f"""CASE WHEN p < {pr.TAIL} THEN {_tail('p')} WHEN p > 1 - {pr.TAIL} THEN -({_tail('(1 - p)')})
    ELSE {_poly('((p - 0.5) * (p - 0.5))', pr.A)} * (p - 0.5) / {_poly('((p - 0.5) * (p - 0.5))', pr.B, 1.0)} END"""


@query(
    "qq_normal",
    f"""
    grid AS (
        SELECT (i - 0.5e0) / 99 AS p FROM range(1, 100) r(i) UNION SELECT 0.25e0 UNION SELECT 0.75e0),
    pool AS (
        SELECT 'raw' AS scale, total_amount AS v FROM s_orders WHERE total_amount > 0
        UNION ALL SELECT 'log', ln(total_amount) FROM s_orders WHERE total_amount > 0),
    ordered AS (SELECT scale, list(v ORDER BY v) AS vs, count(*) AS n FROM pool GROUP BY 1),
    found AS (
        SELECT scale, p, {NORMAL_SQL} AS z,
            vs[CAST(floor(p * (n - 1)) AS BIGINT) + 1] + (p * (n - 1) - floor(p * (n - 1)))
                * (vs[CAST(ceil(p * (n - 1)) AS BIGINT) + 1] - vs[CAST(floor(p * (n - 1)) AS BIGINT) + 1]) AS sample
        FROM ordered, grid),
    quarter AS (
        SELECT scale, max(CASE WHEN p = 0.25 THEN sample END) AS q1, max(CASE WHEN p = 0.75 THEN sample END) AS q3,
            max(CASE WHEN p = 0.25 THEN z END) AS z1, max(CASE WHEN p = 0.75 THEN z END) AS z3
        FROM found GROUP BY 1)
    SELECT scale, round(p + 1e-9, 6) AS p, {q('z')} AS z, {q('sample')} AS sample,
        {q('q1 + (q3 - q1) / (z3 - z1) * (z - z1)')} AS line
    FROM found JOIN quarter USING (scale)""",
)
def qq_normal(spark, sf_dir):
    out = distribution.qq_normal(load_star(spark, sf_dir).orders, "total_amount")
    return out.select(
        "scale", F.round(F.col("p") + 1e-9, 6).alias("p"),
        *[rounded(c).alias(c) for c in ("z", "sample", "line")],
    )


@query(
    "qq_values",
    f"""
    v AS (SELECT total_amount AS value, count(*) AS n FROM s_orders WHERE total_amount > 0 GROUP BY 1),
    r AS (SELECT *, CAST(sum(n) OVER (ORDER BY value) AS BIGINT) AS last_rank, sum(n) OVER () AS total FROM v),
    f AS (SELECT value, n, last_rank, {NORMAL_SQL} AS z_first FROM (SELECT *, (last_rank - n + 0.5e0) / total AS p FROM r)),
    l AS (SELECT value, {NORMAL_SQL} AS z_last FROM (SELECT *, (last_rank - 0.5e0) / total AS p FROM r)),
    b AS (SELECT * FROM f JOIN l USING (value))
    SELECT 'raw' AS scale, {q('value')} AS value, n, last_rank, {q('z_first')} AS z_first, {q('z_last')} AS z_last FROM b
    UNION ALL SELECT 'log', {q('ln(value)')}, n, last_rank, {q('z_first')}, {q('z_last')} FROM b""",
)
def qq_values(spark, sf_dir):
    return show(distribution.qq_values(load_star(spark, sf_dir).orders, "total_amount"))


_NB_LL = """sum(customers * (lgamma(freq + size) - lgamma(size) - lgamma(freq + 1)
    + size * ln(size / (size + mu)) + freq * ln(mu / (size + mu))))"""


@query(
    "freq_poisson_nb",
    f"""{FREQ_SQL},
    mom AS (SELECT avg(freq) AS mu, var_samp(freq) AS var, count(*) AS n, max(freq) AS top
        FROM per_customer),
    start AS (SELECT *, CASE WHEN var > mu THEN mu * mu / (var - mu) END AS size0 FROM mom),
    coarse AS (
        SELECT any_value(mu) AS mu, arg_max(size, ll) AS size1 FROM (
            SELECT mu, size, {_NB_LL} AS ll
            FROM (SELECT freq, customers, mu, size0 * pow(2, j / 4e0) AS size
                FROM freqs, start, range(-16, 17) r(j)) GROUP BY mu, size)),
    fine AS (
        SELECT arg_max(size, ll) AS size FROM (
            SELECT size, {_NB_LL} AS ll
            FROM (SELECT freq, customers, mu, size1 * pow(2, j / 64e0) AS size
                FROM freqs, coarse, range(-16, 17) r(j)) GROUP BY size)),
    finest AS (
        SELECT arg_max(size, ll) AS size FROM (
            SELECT size, {_NB_LL} AS ll
            FROM (SELECT freq, customers, mu, size * pow(2, j / 1024e0) AS size
                FROM freqs, mom, fine, range(-16, 17) r(j)) GROUP BY size))
    SELECT x, customers AS observed,
        {q('n * exp(x * ln(mu) - mu - lgamma(x + 1))')} AS poisson,
        {q('''n * exp(lgamma(x + size) - lgamma(size) - lgamma(x + 1) + size * ln(size / (size + mu))
            + x * ln(mu / (size + mu)))''')} AS negative_binomial
    FROM start, finest, (SELECT *, freq AS x FROM freqs)""",
)
def freq_poisson_nb(spark, sf_dir):
    return show(distribution.frequency_fit(reports.order_frequency(load_star(spark, sf_dir).orders)))


@query(
    "scatter_aov_orders",
    f"""{SEGMENT_SQL}, {RFM_SQL}
    SELECT customer_id, customer_type, order_count, {q('avg_order_value')} AS avg_order_value,
        {q('log10(avg_order_value)')} AS log_aov
    FROM rfm WHERE customer_type IS NOT NULL""",
)
def scatter_aov_orders(spark, sf_dir):
    customers = rfm_table(load_star(spark, sf_dir)).filter(F.col("customer_type").isNotNull())
    return show(
        customers.select(
            "customer_id", "customer_type", "order_count", "avg_order_value",
            F.log10("avg_order_value").alias("log_aov"),
        )
    )


def _cell(c, lo, hi, bins=20):
    return f"""CAST(least(coalesce(floor(({c} - {lo}) / nullif(({hi} - {lo}) / {bins}, 0)), 0), {bins - 1})
        AS BIGINT)"""


@query(
    "scatter_aov_bins",
    f"""{SEGMENT_SQL}, {RFM_SQL},
    s AS (SELECT CAST(min(order_count) AS DOUBLE) AS x0, CAST(max(order_count) AS DOUBLE) AS x1,
        min(log10(avg_order_value)) AS y0, max(log10(avg_order_value)) AS y1 FROM rfm)
    SELECT customer_type, {_cell('CAST(order_count AS DOUBLE)', 'x0', 'x1')} AS x_bin,
        {_cell('log10(avg_order_value)', 'y0', 'y1')} AS y_bin, count(*) AS n
    FROM rfm, s GROUP BY ALL""",
)
def scatter_aov_bins(spark, sf_dir):
    customers = rfm_table(load_star(spark, sf_dir)).filter(F.col("customer_type").isNotNull())
    return distribution.histogram_2d(
        customers.withColumn("log_aov", F.log10("avg_order_value")), "order_count", "log_aov",
        by=["customer_type"],
    )


@query(
    "price_pairs",
    f"""
    SELECT initial_price, {q('final_price')} AS final_price, count(*) AS n, {q('avg(discount_rate_adjusted)')} AS avg_discount
    FROM s_lines JOIN s_products USING (product_id)
    WHERE initial_price IS NOT NULL AND final_price IS NOT NULL GROUP BY initial_price, s_products.final_price""",
)
def price_pairs(spark, sf_dir):
    lines = fact(load_star(spark, sf_dir), "initial_price", "final_price", "discount_rate_adjusted")
    mean = F.avg("discount_rate_adjusted").alias("avg_discount")
    return show(distribution.pair_counts(lines, "initial_price", "final_price", mean))


@query(
    "price_pair_bins",
    f"""
    k AS (SELECT initial_price, final_price, l.discount_rate_adjusted
        FROM s_lines l JOIN s_products USING (product_id)
        WHERE initial_price IS NOT NULL AND final_price IS NOT NULL),
    s AS (SELECT min(initial_price) AS x0, max(initial_price) AS x1, min(final_price) AS y0,
        max(final_price) AS y1 FROM k)
    SELECT {_cell('initial_price', 'x0', 'x1')} AS x_bin, {_cell('final_price', 'y0', 'y1')} AS y_bin,
        count(*) AS n, {q('avg(discount_rate_adjusted)')} AS avg_discount
    FROM k, s GROUP BY ALL""",
)
def price_pair_bins(spark, sf_dir):
    lines = fact(
        load_star(spark, sf_dir), "initial_price", "final_price", "discount_rate_adjusted"
    )
    return show(
        distribution.histogram_2d(
            lines, "initial_price", "final_price",
            measure=F.avg("discount_rate_adjusted").alias("avg_discount"),
        )
    )

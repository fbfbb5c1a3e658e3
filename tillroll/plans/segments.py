"""Scaling, clusters and their diagnostics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.functions.columns import rounded
from tillroll.operators import features, segment
from tillroll.operators.cleaning import complete_rows, label_segments
from tillroll.plans.common import (
    AS_OF, SEGMENT_SQL, SPEND_HIGH, SPEND_LOW, orders_view, rule_cluster, show,
)
from tillroll.plans.registry import q, query
from tillroll.plans.reports import (
    CUST_ITEM_SQL, CUST_ORDER_SQL, PROD_SALES_SQL, RFM_SQL, customer_items, product_sales, rfm_table,
)
from tillroll.session import pinned
from tillroll.sources.star import load_star

CUSTOMER = features.CUSTOMER_FEATURES
PRODUCT = features.PRODUCT_FEATURES


def customer_features(star):
    """All customer features, kept: clustering reads them many times."""
    return pinned(
        features.join_features(
            features.customer_order_features(orders_view(star), AS_OF),
            customer_items(star),
            key="customer_id",
        )
    )


def product_features(star):
    """Product features with the catalogue's still empty rating set to 0."""
    return pinned(product_sales(star).withColumn("rating", F.lit(0.0)))


def clustered_by_rule(star):
    """Standardised customer features with the rule-based cluster."""
    feats = customer_features(star)
    cluster = rule_cluster(F.col("total_line_value"), SPEND_LOW, SPEND_HIGH)
    return segment.standardize(feats, CUSTOMER).withColumn("cluster", cluster)


Z_SQL = f"""{CUST_ORDER_SQL}, {CUST_ITEM_SQL}, {SEGMENT_SQL},
    feats AS (
        SELECT customer_id, {', '.join(CUSTOMER)}
        FROM cust_order JOIN cust_item USING (customer_id)),
    z AS (
        SELECT customer_id,
            {', '.join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS z_{c}" for c in CUSTOMER)}
        FROM feats)"""


@query(
    "feature_variance",
    f"""{PROD_SALES_SQL},
    f AS (SELECT *, 0e0 AS rating FROM prod_sales)
    {' UNION ALL '.join(
        f"SELECT '{c}' AS feature, {q(f'stddev_samp({c})')} AS sd, stddev_samp({c}) = 0 AS constant, "
        f"CASE WHEN stddev_samp({c}) = 0 THEN {q(f'CAST(min({c}) AS DOUBLE)')} END AS only_value FROM f"
        for c in PRODUCT)}""",
)
def feature_variance(spark, sf_dir):
    feats = product_sales(load_star(spark, sf_dir)).withColumn("rating", F.lit(0.0))
    return show(segment.feature_variance(feats, PRODUCT))


@query(
    "zscore",
    f"""{Z_SQL} SELECT customer_id, {', '.join(f"{q(f'z_{c}')} AS z_{c}" for c in CUSTOMER)} FROM z""",
)
def zscore(spark, sf_dir):
    scaled = segment.standardize(customer_features(load_star(spark, sf_dir)), CUSTOMER)
    return show(scaled.select("customer_id", *[f"z_{c}" for c in CUSTOMER]))


@query(
    "cluster_centers",
    f"""{Z_SQL}
    SELECT cluster, {', '.join(f"{q(f'avg(z_{c})')} AS z_{c}" for c in CUSTOMER)}
    FROM z JOIN s_segment USING (customer_id) GROUP BY cluster""",
)
def cluster_centers(spark, sf_dir):
    tagged = clustered_by_rule(load_star(spark, sf_dir))
    return show(segment.cluster_centers(tagged, [f"z_{c}" for c in CUSTOMER]))


SILHOUETTE_SQL = f"""{Z_SQL},
    long AS (
        UNPIVOT (SELECT z.*, cluster FROM z JOIN s_segment USING (customer_id))
        ON COLUMNS('z_.*') INTO NAME f VALUE v),
    mean AS (SELECT cluster, f, avg(v) AS m FROM long GROUP BY 1, 2),
    norm AS (SELECT customer_id, cluster, sum(v * v) AS nn FROM long GROUP BY 1, 2),
    square AS (SELECT cluster, avg(nn) AS sq, count(*) AS n FROM norm GROUP BY 1),
    dots AS (
        SELECT long.customer_id, mean.cluster AS other, sum(v * m) AS dot
        FROM long JOIN mean USING (f) GROUP BY 1, 2),
    dist AS (
        SELECT norm.customer_id, norm.cluster, other, n,
            greatest(nn + sq - 2 * dot, 0) AS d
        FROM norm JOIN dots USING (customer_id) JOIN square ON square.cluster = other),
    own AS (SELECT customer_id, cluster, d * n / nullif(n - 1, 0) AS a, n FROM dist WHERE cluster = other),
    near AS (SELECT customer_id, min(d) AS b, arg_min(other, d) AS neighbor
        FROM dist WHERE cluster <> other GROUP BY 1),
    detail AS (
        SELECT customer_id, cluster, neighbor,
            CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END AS sil_width
        FROM own JOIN near USING (customer_id))"""


@query(
    "silhouette_detail",
    f"{SILHOUETTE_SQL} SELECT customer_id, cluster, neighbor, {q('sil_width')} AS sil_width FROM detail",
)
def silhouette_detail(spark, sf_dir):
    tagged = clustered_by_rule(load_star(spark, sf_dir))
    return show(segment.silhouette_detail(tagged, [f"z_{c}" for c in CUSTOMER], "customer_id"))


@query(
    "silhouette_summary",
    f"""{SILHOUETTE_SQL}
    SELECT cluster, count(*) AS n, {q('avg(sil_width)')} AS avg_width,
        {q('min(sil_width)')} AS min_width, {q('max(sil_width)')} AS max_width
    FROM detail GROUP BY cluster""",
)
def silhouette_summary(spark, sf_dir):
    tagged = clustered_by_rule(load_star(spark, sf_dir))
    detail = segment.silhouette_detail(tagged, [f"z_{c}" for c in CUSTOMER], "customer_id")
    return show(segment.silhouette_summary(detail))


# --- models: checked by rows and by unit tests ------------------------------------


@query("kmeans_customers")
def kmeans_customers(spark, sf_dir):
    feats = customer_features(load_star(spark, sf_dir))
    found = segment.segment(feats, CUSTOMER, k=3, rank_by="total_spend")
    return label_segments(found.select("customer_id", "cluster", "total_spend", "order_count"))


@query("kmeans_products")
def kmeans_products(spark, sf_dir):
    feats = product_features(load_star(spark, sf_dir))
    found = segment.segment(feats, PRODUCT, k=2, rank_by="total_revenue")
    return found.select("product_id", "cluster", "total_quantity", "total_revenue")


def _by_k(spark, sf_dir, measure):
    scaled = segment.scaled_features(customer_features(load_star(spark, sf_dir)), CUSTOMER)[0]
    scaled = scaled.persist()
    try:
        return measure(scaled)
    finally:
        scaled.unpersist()


@query("wss_by_k")
def wss_by_k(spark, sf_dir):
    return _by_k(spark, sf_dir, segment.wss_by_k)


@query("silhouette_by_k")
def silhouette_by_k(spark, sf_dir):
    return _by_k(spark, sf_dir, segment.silhouette_by_k)


# --- what is certain about the models -----------------------------------------------


@query(
    "kmeans_check",
    f"""{CUST_ORDER_SQL}, {CUST_ITEM_SQL}, {PROD_SALES_SQL}
    SELECT 'customers' AS part, count(*) AS n, CAST(3 AS BIGINT) AS clusters, {q('sum(total_spend)', 0)} AS measure,
        TRUE AS settled FROM cust_order JOIN cust_item USING (customer_id)
    UNION ALL SELECT 'products', count(*), 2, {q('sum(total_revenue)', 0)}, TRUE FROM prod_sales""",
)
def kmeans_check(spark, sf_dir):
    """Nobody is lost, and all but a few border rows are nearest to their own cluster's mean."""
    star = load_star(spark, sf_dir)
    out = None
    for name, feats, columns, k, measure in (
        ("customers", customer_features(star), CUSTOMER, 3, "total_spend"),
        ("products", product_features(star), PRODUCT, 2, "total_revenue"),
    ):
        found = pinned(segment.segment(feats, columns, k, measure))
        z = [c for c in found.columns if c.startswith("z_")]
        total = found.agg(F.sum(measure)).scalar()
        row = segment.misplaced(found, z).select(
            F.lit(name).alias("part"), "n", "clusters", rounded(total, 0).alias("measure"),
            (F.col("misplaced") <= 0.05 * F.col("n")).alias("settled"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "transfer_check",
    f"""{CUST_ORDER_SQL}, {CUST_ITEM_SQL}, {PROD_SALES_SQL}
    SELECT 'customers' AS part, count(*) AS n, TRUE AS no_dearer, CAST(0 AS BIGINT) AS movable
    FROM cust_order JOIN cust_item USING (customer_id)
    UNION ALL SELECT 'products', count(*), TRUE, 0 FROM prod_sales""",
)
def transfer_check(spark, sf_dir):
    """Moving single points never ends above Lloyd's cost, and leaves none whose move would still pay."""
    star = load_star(spark, sf_dir)
    out = None
    for name, feats, columns, k, measure in (
        ("customers", customer_features(star), CUSTOMER, 3, "total_spend"),
        ("products", product_features(star), PRODUCT, 2, "total_revenue"),
    ):
        before = pinned(segment.segment(feats, columns, k, measure, restarts=1, transfer=False))
        z = [c for c in before.columns if c.startswith("z_")]
        after = segment.transferred(before, z)
        costs = [segment.cluster_moments(t, z, "cluster")[1] for t in (before, after)]
        row = after.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("part"), "n", F.lit(costs[1] <= costs[0]).alias("no_dearer"),
            F.lit(segment.movable(after, z)).cast("bigint").alias("movable"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "cost_by_k_check",
    f"""{Z_SQL}
    SELECT CAST(k AS INTEGER) AS k, CASE WHEN k = 1 THEN {q(f'CAST({len(CUSTOMER)} * (n - 1) AS DOUBLE)', 2)} END AS whole,
        TRUE AS falls, TRUE AS in_range
    FROM (SELECT count(*) AS n FROM z), range(1, 11) r(k)""",
)
def cost_by_k_check(spark, sf_dir):
    """One cluster costs the whole sum of squares, more cost less, and widths lie between -1 and 1."""
    scaled = segment.scaled_features(customer_features(load_star(spark, sf_dir)), CUSTOMER)[0].persist()
    try:
        models = segment.models_by_k(scaled)
        cost = segment.wss_by_k(scaled, models=models)
        width = segment.silhouette_by_k(scaled, models=models)
    finally:
        scaled.unpersist()
    before = F.lag("wss").over(Window.partitionBy().orderBy("k"))
    return cost.withColumn("_before", before).join(width, "k", "left").select(
        "k",
        F.when(F.col("k") == 1, rounded("wss", 2)).alias("whole"),
        F.coalesce(F.col("wss") < F.col("_before"), F.lit(True)).alias("falls"),
        F.coalesce(F.col("silhouette").between(-1, 1), F.lit(True)).alias("in_range"),
    )


def _pca_sql(source, keys, columns):
    """Two components by repeated squaring of the cross-product matrix.

    The squares tend to the projector on the leading axis; the row with the
    largest diagonal entry is that axis with its largest loading positive.
    """
    def axis(name, matrix):
        return f"""
    {name}_power AS (
        WITH RECURSIVE p AS (
            SELECT 0 AS k, m FROM {matrix}
            UNION ALL
            SELECT k + 1, list_transform(sq, lambda a: list_transform(a, lambda x: x / list_sum(
                list_transform(range(1, len(sq) + 1), lambda i: sq[i][i]))))
            FROM (SELECT k, list_transform(m, lambda a: list_transform(m,
                lambda b: list_dot_product(a, b))) AS sq FROM p WHERE k < 24))
        SELECT m FROM p WHERE k = 24),
    {name} AS (
        SELECT list_transform(m[place], lambda x: x / sqrt(m[place][place])) AS v
        FROM (SELECT m, list_position(d, list_max(d)) AS place FROM (
            SELECT m, list_transform(range(1, len(m) + 1), lambda i: m[i][i]) AS d FROM {name}_power)))"""

    z = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}" for c in columns)
    point = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in columns) + "]"
    pairs = ", ".join(
        "[" + ", ".join(f"sum({a} * {b})" for b in columns) + "]" for a in columns
    )
    return f"""
    pz AS (SELECT {keys}, {z} FROM {source}),
    cross1 AS (SELECT [{pairs}] AS m FROM pz),
    {axis('axis1', 'cross1')},
    cross2 AS (
        SELECT list_transform(range(1, len(m) + 1), lambda i: list_transform(range(1, len(m) + 1),
            lambda j: m[i][j] - v[i] * v[j] * list_dot_product(v, list_transform(m,
                lambda a: list_dot_product(a, v))))) AS m
        FROM cross1, axis1),
    {axis('axis2', 'cross2')}
    SELECT {keys}, {q(f'list_dot_product({point}, axis1.v)')} AS PC1,
        {q(f'list_dot_product({point}, axis2.v)')} AS PC2
    FROM pz, axis1, axis2"""


@query(
    "pca_customers",
    f"""{CUST_ORDER_SQL}, {CUST_ITEM_SQL}, {SEGMENT_SQL},
    feats AS (
        SELECT customer_id, cluster, {', '.join(CUSTOMER)}
        FROM cust_order JOIN cust_item USING (customer_id) JOIN s_segment USING (customer_id)),
    {_pca_sql('feats', 'customer_id, cluster', CUSTOMER)}""",
)
def pca_customers(spark, sf_dir):
    star = load_star(spark, sf_dir)
    scaled, _ = segment.scaled_features(customer_features(star), CUSTOMER)
    cluster = rule_cluster(F.col("total_line_value"), SPEND_LOW, SPEND_HIGH)
    return show(
        segment.principal_components(scaled.withColumn("cluster", cluster), ["customer_id", "cluster"])
    )


RFM_COLUMNS = ["frequency", "monetary", "avg_order_value", "recency_days"]


@query(
    "pca_customers_rfm",
    f"""{SEGMENT_SQL}, {RFM_SQL},
    feats AS (SELECT *, order_count AS frequency FROM rfm),
    {_pca_sql('feats', 'customer_id, customer_type', RFM_COLUMNS)}""",
)
def pca_customers_rfm(spark, sf_dir):
    """The report variant: frequency, spend, order value and recency only."""
    base = complete_rows(
        rfm_table(load_star(spark, sf_dir)), RFM_COLUMNS, {"recency_days": 9999}
    )
    scaled, _ = segment.scaled_features(pinned(base), RFM_COLUMNS)
    return show(segment.principal_components(scaled, ["customer_id", "customer_type"]))


@query(
    "pca_products",
    f"""{PROD_SALES_SQL},
    {_pca_sql('prod_sales', 'product_id', [c for c in PRODUCT if c != 'rating'])}""",
)
def pca_products(spark, sf_dir):
    scaled, _ = segment.scaled_features(product_features(load_star(spark, sf_dir)), PRODUCT)
    return show(segment.principal_components(scaled, ["product_id"]))

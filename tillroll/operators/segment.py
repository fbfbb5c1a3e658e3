"""Feature scaling, k-means segments and their diagnostics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.arrays import array_sum
from tillroll.functions.columns import finite_or_zero
from tillroll.session import pinned

T = TypeVar("T")


def feature_variance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, sd, constant, only_value)`` from one pass over the table."""
    spread = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.stddev_samp(c).alias("sd"),
                    F.min(c).cast("double").alias("low"),
                )
                for c in columns
            ]
        ).alias("_all")
    )
    long = spread.select(F.explode("_all").alias("_s"))
    constant = F.col("_s.sd").isNull() | F.isnan("_s.sd") | (F.col("_s.sd") == 0)
    return long.select(
        "_s.feature",
        F.col("_s.sd").alias("sd"),
        constant.alias("constant"),
        F.when(constant, F.col("_s.low")).alias("only_value"),
    )


def drop_constant(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The features that vary; raises when fewer than two are left."""
    constant = {
        r["feature"] for r in feature_variance(df, columns).filter("constant").collect()
    }
    kept = [c for c in columns if c not in constant]
    if len(kept) < 2:
        raise ValueError("fewer than two features vary")
    return kept


def standardize(df: DataFrame, columns: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Adds ``(x - mean) / sd`` per feature; a non-finite result fails the job."""
    moments = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns],
            *[F.stddev_samp(c).alias(f"s_{c}") for c in columns],
        )
    ).scalar()

    def scaled(c: str) -> Column:
        z = F.try_divide(F.col(c) - F.col(f"_mom.m_{c}"), F.col(f"_mom.s_{c}"))
        bad = z.isNull() | F.isnan(z) | (F.abs(z) == float("inf"))
        return F.when(bad, F.raise_error(F.lit(f"scaled {c} is not finite"))).otherwise(z)

    return (
        df.withColumn("_mom", moments)
        .withColumns({f"{prefix}{c}": scaled(c) for c in columns})
        .drop("_mom")
    )


def scaled_features(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Finite, varying and standardised features with a vector column."""
    clean = df.withColumns({c: finite_or_zero(c) for c in columns})
    kept = drop_constant(clean, columns)
    scaled = standardize(clean, kept)
    z = [f"z_{c}" for c in kept]
    return VectorAssembler(inputCols=z, outputCol="features").transform(scaled), z


def _kmeans(k: int, seed: int) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="_cluster")


def _side_by_side(
    df: DataFrame, task: Callable[[int], T], items: Sequence[int], parallelism: int
) -> list[T]:
    """Results of independent jobs over ``df``, a few in flight at a time."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(inheritable_thread_target(df.sparkSession)(task), items))


def _fits(df: DataFrame, starts: Sequence[tuple[int, int]], parallelism: int) -> list[KMeansModel]:
    """Models for ``(k, seed)`` pairs, as many in flight as the cores need, at most ``parallelism``.

    Spark keeps the points of a fit as objects only if the table given to it
    isn't a persisted one; else each round unpacks every row anew. So a
    selection is given, which still reads a persisted ``df`` once per fit.
    """
    points = df.select("features")
    cores = df.sparkSession.sparkContext.defaultParallelism
    needed = max(4, 8 * cores // points.rdd.getNumPartitions())
    return _side_by_side(
        df, lambda i: _kmeans(*starts[i]).fit(points), range(len(starts)), min(parallelism, needed)
    )


def best_kmeans(
    df: DataFrame, k: int, restarts: int = 25, seed: int = 42, parallelism: int = 8
) -> KMeansModel:
    """The model with the lowest cost over ``restarts`` seeded starts."""
    models = _fits(df, [(k, s) for s in range(seed, seed + restarts)], parallelism)
    return min(models, key=lambda m: m.summary.trainingCost)


def ranked_clusters(df: DataFrame, rank_by: str) -> DataFrame:
    """Renames ``_cluster`` to ``cluster`` 1..k in order of the mean of ``rank_by``."""
    means = df.groupBy("_cluster").agg(F.avg(rank_by).alias("_m")).collect()
    order = sorted(means, key=lambda r: (r["_m"], r["_cluster"]))
    place = None
    for i, r in enumerate(order, 1):
        hit = F.col("_cluster") == r["_cluster"]
        place = F.when(hit, i) if place is None else place.when(hit, i)
    return df.withColumn("cluster", place).drop("_cluster")


# Rows of one partition while clusters are fitted.
FIT_ROWS = 100_000


def arranged(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows dealt and ordered by their values alone, however they arrived.

    Seeded starts draw from each partition, so the same rows must lie in the
    same places for the same clusters to be found.
    """
    parts = df.count() // FIT_ROWS + 1
    place = F.xxhash64(*[F.col(c) for c in columns])
    return df.repartition(parts, place).sortWithinPartitions(place, *columns)


def segment(
    df: DataFrame, columns: Sequence[str], k: int, rank_by: str, restarts: int = 25, seed: int = 42, transfer: bool = True
) -> DataFrame:
    """Adds ``cluster`` from k-means over the standardised features.

    The best of ``restarts`` runs is improved by ``transferred`` unless that is
    switched off. ``df`` is read once per iteration and should be a pinned or
    written table.
    """
    scaled, z = scaled_features(arranged(df, columns), columns)
    scaled = scaled.persist()
    try:
        model = best_kmeans(scaled, k, restarts, seed)
        found = model.transform(scaled).drop("features")
        return ranked_clusters(transferred(found, z, "_cluster") if transfer else found, rank_by)
    finally:
        scaled.unpersist()


# Least fall of the cost, as a share of a point's own part of it, for which the point moves.
LEAST_GAIN = 1e-9


def cluster_moments(df: DataFrame, z: Sequence[str], cluster: str) -> tuple[dict[int, tuple[int, list[float]]], float]:
    """Size and mean of each cluster, and the sum of squares around the means."""
    norm = sum((F.col(c) * F.col(c) for c in z), F.lit(0.0))
    rows = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in z]).alias("mean"), F.sum(norm).alias("square")
    ).collect()
    cost = sum(r["square"] - r["n"] * sum(m * m for m in r["mean"]) for r in rows)
    return {r[cluster]: (r["n"], list(r["mean"])) for r in rows}, cost


def _best_move(z: Sequence[str], cluster: str, moments: dict[int, tuple[int, list[float]]]) -> tuple[Column, Column]:
    """How far the cost falls if the point alone moves to the best other cluster, and that cluster.

    Leaving a cluster of ``n`` saves ``n / (n - 1)`` of the squared distance to
    its mean, joining one costs ``n / (n + 1)`` of it. The last point of a
    cluster stays.
    """
    own, others = F.lit(0.0), []
    for c, (n, mean) in moments.items():
        distance = sum(((F.col(name) - F.lit(float(m))) ** 2 for name, m in zip(z, mean, strict=True)), F.lit(0.0))
        here = F.col(cluster) == c
        own = F.when(here, distance * (n / (n - 1)) if n > 1 else F.lit(0.0)).otherwise(own)
        others.append(F.when(~here, F.struct((distance * (n / (n + 1))).alias("cost"), F.lit(c).alias("to"))))
    # The least of those that are there; a single cluster has no other.
    best = F.least(*others) if len(others) > 1 else others[0]
    gain = own - best["cost"]
    return F.when(gain > LEAST_GAIN * F.greatest(own, F.lit(1e-12)), gain), best["to"]


def movable(df: DataFrame, z: Sequence[str], cluster: str = "cluster") -> int:
    """Points whose move to another cluster would make the cost fall."""
    gain, _ = _best_move(z, cluster, cluster_moments(df, z, cluster)[0])
    return df.filter(gain.isNotNull()).count()


# Rounds of moves after which the chain of kept states is cut.
KEPT_ROUNDS = 8


def transferred(df: DataFrame, z: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Moves points between clusters until no single move makes the cost fall.

    Points move in rounds, all that gain at once. Moves of one round can spoil
    each other; a round after which the cost isn't lower is undone, and fewer
    points, chosen by a hash, move in the next, in the end the one that gains
    most. So the cost falls with every round that counts.

    The rows are stored before and after. Between, a round keeps the points and
    their clusters only, in memory where there is room; every few rounds they
    are stored, so that a lost executor costs those rounds.
    """
    base = pinned(df.withColumn("_row", F.monotonically_increasing_id()))
    state = base.select("_row", *z, F.col(cluster), F.col(cluster).alias("_was")).persist()
    kept, rounds = [state], 0
    try:
        moments, cost = cluster_moments(state, z, cluster)
        share = 1.0
        while len(moments) > 1:
            gain, to = _best_move(z, cluster, moments)
            marked = state.select("_row", gain.alias("_gain"))
            told = marked.agg(F.count("_gain").alias("n"), F.max_by("_row", F.struct("_gain", -F.col("_row"))).alias("best")).first()
            if not told["n"]:
                break
            if share * told["n"] < 1:
                moves = F.col("_row") == told["best"]
            else:
                moves = F.pmod(F.xxhash64("_row"), F.lit(1 << 20)) < int(share * (1 << 20))
            after = state.withColumn(cluster, F.when(gain.isNotNull() & moves, to).otherwise(F.col(cluster))).persist()
            kept.append(after)
            new_moments, new_cost = cluster_moments(after, z, cluster)
            if new_cost < cost:
                state, moments, cost, share = after, new_moments, new_cost, min(1.0, 2 * share)
                rounds += 1
                if rounds % KEPT_ROUNDS == 0:
                    state = pinned(after)
                    kept.append(state.persist())
                    _forget(kept[:-1])
                    del kept[:-1]
            elif share * told["n"] < 1:
                # Not even the best move helps beyond rounding.
                break
            else:
                share /= 4
                _forget([kept.pop()])
        if not rounds:
            return base.drop("_row")
        moved = state.filter(~F.col(cluster).eqNullSafe(F.col("_was"))).select("_row", F.col(cluster).alias("_now"))
        placed = base.join(moved, "_row", "left").withColumn(cluster, F.coalesce("_now", F.col(cluster)))
        return pinned(placed.select(*df.columns))
    finally:
        _forget(kept)


def _forget(tables: Sequence[DataFrame]) -> None:
    for t in tables:
        t.unpersist()


def models_by_k(scaled: DataFrame, k_max: int = 10, seed: int = 42, parallelism: int = 8) -> dict[int, KMeansModel]:
    """One seeded model for each number of clusters from 2 to ``k_max``."""
    ks = range(2, k_max + 1)
    return dict(zip(ks, _fits(scaled, [(k, seed) for k in ks], parallelism), strict=True))


def wss_by_k(
    scaled: DataFrame, k_max: int = 10, seed: int = 42, parallelism: int = 8,
    models: dict[int, KMeansModel] | None = None,
) -> DataFrame:
    """``(k, wss)``; k = 1 is the total sum of squares.

    ``models`` from ``models_by_k`` over the same rows spare the fits.
    """
    x = vector_to_array("features")
    width = scaled.select(F.size(x)).first()[0]
    total = scaled.agg(
        sum((F.var_pop(x[i]) for i in range(width)), F.lit(0.0)).alias("v"), F.count(F.lit(1)).alias("n")
    ).first()
    rows = [(1, float(total["v"] * total["n"]))]
    if models is None:
        models = models_by_k(scaled, k_max, seed, parallelism)
    rows += [(k, float(m.summary.trainingCost)) for k, m in models.items()]
    return scaled.sparkSession.createDataFrame(rows, "k int, wss double")


def silhouette_by_k(
    scaled: DataFrame, k_max: int = 10, seed: int = 42, parallelism: int = 8,
    models: dict[int, KMeansModel] | None = None,
) -> DataFrame:
    """``(k, silhouette)`` for 2 to ``k_max`` clusters, with ``models`` as in ``wss_by_k``."""
    judge = ClusteringEvaluator(predictionCol="_cluster", featuresCol="features")
    found = models_by_k(scaled, k_max, seed, parallelism) if models is None else models
    points = scaled.select("features")
    rows = _side_by_side(
        scaled, lambda k: (k, float(judge.evaluate(found[k].transform(points)))), list(found), parallelism
    )
    return scaled.sparkSession.createDataFrame(rows, "k int, silhouette double")


def silhouette_detail(df: DataFrame, z: Sequence[str], key: str, cluster: str = "cluster") -> DataFrame:
    """``(key, cluster, neighbor, sil_width)`` with squared Euclidean distances.

    The mean squared distance of a point to a cluster follows from the
    cluster's size, mean and mean squared norm, so no pair of points is formed.
    One row per cluster is sent to every task.
    """
    point = F.array(*[F.col(c).cast("double") for c in z])
    norm = sum((F.col(c) * F.col(c) for c in z), F.lit(0.0))
    clusters = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in z]).alias("mean"),
        F.avg(norm).alias("square"),
    )
    summary = clusters.agg(F.collect_list(F.struct(F.col(cluster).alias("c"), "n", "mean", "square")))

    def distance(s: Column) -> Column:
        dot = array_sum(F.zip_with("_x", s["mean"], lambda a, b: a * b))
        return F.greatest(F.col("_norm") + s["square"] - 2 * dot, F.lit(0.0))

    with_distances = (
        df.select(key, cluster, point.alias("_x"), norm.alias("_norm"))
        .withColumn("_all", summary.scalar())
        .withColumn(
            "_d",
            F.transform(
                "_all",
                lambda s: F.struct(distance(s).alias("d"), s["c"].alias("c"), s["n"].alias("n")),
            ),
        )
    )
    own = F.get(F.filter("_d", lambda d: d["c"] == F.col(cluster)), F.lit(0))
    other = F.array_min(F.filter("_d", lambda d: d["c"] != F.col(cluster)))
    with_distances = with_distances.withColumns({"_own": own, "_other": other})
    # The point itself is no neighbour: the mean is over the n - 1 others.
    n = F.col("_own.n")
    a = F.when(n > 1, F.col("_own.d") * n / F.nullif(n - 1, F.lit(0)))
    b = F.col("_other.d")
    width = F.when(n == 1, 0.0).otherwise(
        F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))
    )
    return with_distances.select(
        key, cluster, F.col("_other.c").alias("neighbor"), width.alias("sil_width")
    )


def silhouette_summary(detail: DataFrame, cluster: str = "cluster") -> DataFrame:
    return detail.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("sil_width").alias("avg_width"),
        F.min("sil_width").alias("min_width"),
        F.max("sil_width").alias("max_width"),
    )


def misplaced(df: DataFrame, z: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """``(n, clusters, misplaced)``: rows nearer to another cluster's mean than to their own."""
    means = df.groupBy(cluster).agg(F.array(*[F.avg(c) for c in z]).alias("mean"))
    every = means.agg(F.collect_list(F.struct(F.col(cluster).alias("c"), "mean"))).scalar()
    point = F.array(*[F.col(c).cast("double") for c in z])

    def distance(m: Column) -> Column:
        return array_sum(F.zip_with("_x", m["mean"], lambda a, b: (a - b) * (a - b)))

    placed = df.select(cluster, point.alias("_x")).withColumn("_all", every)
    nearest = F.array_min(F.transform("_all", lambda m: F.struct(distance(m).alias("d"), m["c"].alias("c"))))
    placed = placed.withColumn("_near", nearest["c"])
    return placed.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(cluster).alias("clusters"),
        F.count_if(F.col("_near") != F.col(cluster)).alias("misplaced"),
    )


def principal_components(scaled: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns with PC1 and PC2 of the scaled vectors.

    Each component points to where its largest loading is positive.
    """
    model = PCA(k=2, inputCol="features", outputCol="_pc").fit(scaled)
    loadings = model.pc.toArray()
    signs = [float(np.sign(loadings[np.argmax(np.abs(loadings[:, i])), i])) for i in range(2)]
    pc = vector_to_array("_pc")
    return model.transform(scaled).select(
        *keep, (pc[0] * signs[0]).alias("PC1"), (pc[1] * signs[1]).alias("PC2")
    )


def cluster_centers(df: DataFrame, z: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean of every scaled feature per cluster."""
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in z])

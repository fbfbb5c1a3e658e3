"""How often clustering reads, fits and stores its rows."""

import numpy as np
import pytest

from tillroll.operators import segment
from tillroll.plans import load


@pytest.fixture(scope="module")
def cloud(spark):
    rows = [(i, *map(float, x)) for i, x in enumerate(np.random.default_rng(3).normal(size=(400, 2)))]
    return spark.createDataFrame(rows, "id int, a double, b double")


def test_fits_get_rows_that_spark_keeps_as_objects(cloud, monkeypatch):
    scaled, _ = segment.scaled_features(cloud, ["a", "b"])
    scaled = scaled.persist()
    given, real = [], segment._kmeans

    class Fit:
        def __init__(self, k, seed):
            self.model = real(k, seed)

        def fit(self, df):
            given.append(df)
            return self.model.fit(df)

    monkeypatch.setattr(segment, "_kmeans", Fit)
    want = min(real(3, s).fit(scaled).summary.trainingCost for s in (42, 43, 44))
    assert segment.best_kmeans(scaled, 3, restarts=3).summary.trainingCost == pytest.approx(want)
    segment.wss_by_k(scaled, 3)
    segment.silhouette_by_k(scaled, 3)
    assert len(given) == 7
    for df in given:
        assert not df.storageLevel.useMemory and not df.storageLevel.useDisk
    scaled.unpersist()


def test_cost_and_width_share_their_fits(spark, monkeypatch):
    starts, real = [], segment._kmeans
    monkeypatch.setattr(segment, "_kmeans", lambda k, seed: starts.append(k) or real(k, seed))
    assert load()[0]["cost_by_k_check"](spark, "/root/testdata/sf0.001").count() == 10
    assert sorted(starts) == list(range(2, 11))


def moved_one_table_per_round(df, z, cluster="cluster"):
    """Clusters after the same rounds over arrays, and how many rounds counted."""
    rows = df.collect()
    x, c = np.array([[r[v] for v in z] for r in rows]), np.array([r[cluster] for r in rows])
    ks = sorted(set(c))

    def cost(c):
        return sum(((x[c == k] - x[c == k].mean(0)) ** 2).sum() for k in ks)

    def gains(c):
        n = np.array([(c == k).sum() for k in ks])
        d = np.stack([((x - x[c == k].mean(0)) ** 2).sum(1) for k in ks], 1)
        at = np.searchsorted(ks, c)
        own = d[np.arange(len(c)), at] * n[at] / (n[at] - 1)
        join = d * n / (n + 1)
        join[np.arange(len(c)), at] = np.inf
        return own - join.min(1), np.array(ks)[join.argmin(1)]

    counted = 0
    while True:
        gain, to = gains(c)
        if not (gain > 1e-9).any():
            return cost(c), counted
        after = np.where(gain > 1e-9, to, c)
        if cost(after) >= cost(c):
            i = gain.argmax()
            after = c.copy()
            after[i] = to[i]
        c, counted = after, counted + 1


def test_rounds_of_moves_are_not_stored_one_by_one(cloud, monkeypatch):
    scaled, z = segment.scaled_features(cloud, ["a", "b"])
    df = scaled.drop("features").selectExpr("*", "id % 3 as cluster").coalesce(1)
    least, counted = moved_one_table_per_round(df, z)
    assert counted > 3
    stored, real = [], segment.pinned
    monkeypatch.setattr(segment, "pinned", lambda t: stored.append(t.columns) or real(t))
    after = segment.transferred(df, z)
    assert len(stored) <= 2 + counted // segment.KEPT_ROUNDS
    assert after.columns == df.columns and after.count() == 400
    assert segment.movable(after, z) == 0
    assert segment.cluster_moments(after, z, "cluster")[1] == pytest.approx(least, rel=0.02)
    assert {(r["id"], r["a"], r["z_a"]) for r in after.collect()} == {(r["id"], r["a"], r["z_a"]) for r in df.collect()}


def test_settled_clusters_come_back_as_they_are(cloud):
    scaled, z = segment.scaled_features(cloud, ["a", "b"])
    once = segment.transferred(scaled.drop("features").selectExpr("*", "id % 3 as cluster"), z)
    again = segment.transferred(once, z)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in once.collect()}
    alone = segment.transferred(scaled.drop("features").selectExpr("*", "1 as cluster"), z)
    assert alone.count() == 400 and segment.movable(alone, z) == 0

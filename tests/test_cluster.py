"""Ward linkage vs a brute-force merge, cluster agreement measures, elbow rule."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import cluster as K


def brute_ward(X):
    clusters = {i: [i] for i in range(len(X))}
    nxt, heights = len(X), []
    while len(clusters) > 1:
        best = None
        keys = sorted(clusters)
        for i, a in enumerate(keys):
            for b in keys[i + 1:]:
                A, B = X[clusters[a]], X[clusters[b]]
                d = np.sqrt(2 * len(A) * len(B) / (len(A) + len(B))) * np.linalg.norm(A.mean(0) - B.mean(0))
                if best is None or d < best[0]:
                    best = (d, a, b)
        d, a, b = best
        heights.append(d)
        clusters[nxt] = clusters.pop(a) + clusters.pop(b)
        nxt += 1
    return heights


def test_ward_matches_brute_force():
    rnd = np.random.default_rng(3)
    X = rnd.normal(size=(14, 3))
    link = K.ward_linkage(X, np.ones(len(X)))
    assert list(link[:, 2]) == pytest.approx(brute_ward(X), rel=1e-9)
    assert link[-1, 3] == len(X)
    lab = K.cut_linkage(link, len(X), 3)
    assert len(set(lab)) == 3


@pytest.mark.parametrize("linkage,pick", [("single", min), ("complete", max), ("average", lambda v: sum(v) / len(v))])
def test_linkages_match_brute_force(linkage, pick):
    X = np.random.default_rng(5).normal(size=(12, 2))
    groups, heights = [[i] for i in range(len(X))], []
    while len(groups) > 1:
        d, a, b = min((pick([float(np.linalg.norm(X[i] - X[j])) for i in groups[a] for j in groups[b]]), a, b)
                      for a in range(len(groups)) for b in range(a + 1, len(groups)))
        heights.append(d)
        groups[a] += groups.pop(b)
    assert list(K.agglomerate(X, np.ones(len(X)), linkage)[:, 2]) == pytest.approx(heights, rel=1e-9)
    with pytest.raises(ValueError):
        K.agglomerate(X, np.ones(len(X)), "nope")


def test_weighted_ward_equals_points():
    """Merging duplicated points as one weighted leaf gives the same top merges."""
    X = np.array([[0.0, 0.0], [0.0, 0.0], [5.0, 5.0], [5.0, 5.0], [5.0, 5.0], [10.0, 0.0]])
    full = K.ward_linkage(X, np.ones(6))
    micro = K.ward_linkage(np.array([[0.0, 0.0], [5.0, 5.0], [10.0, 0.0]]), np.array([2.0, 3.0, 1.0]))
    assert list(full[-2:, 2]) == pytest.approx(list(micro[:, 2]))


def test_ari_purity_inertia(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.randint(0, 2), rnd.randint(0, 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    assert K.ari(df, "a", "a").first()[0] == pytest.approx(1.0)
    # brute-force ARI
    from math import comb
    n = len(rows)
    cells, ra, rb = {}, {}, {}
    for _, a, b in rows:
        cells[(a, b)] = cells.get((a, b), 0) + 1
        ra[a] = ra.get(a, 0) + 1
        rb[b] = rb.get(b, 0) + 1
    sij = sum(comb(v, 2) for v in cells.values())
    sa, sb = sum(comb(v, 2) for v in ra.values()), sum(comb(v, 2) for v in rb.values())
    e = sa * sb / comb(n, 2)
    assert K.ari(df, "a", "b").first()[0] == pytest.approx((sij - e) / ((sa + sb) / 2 - e))
    tie = spark.createDataFrame([(0, 2), (0, 1), (1, 1)], "c int, y int")
    p = {r["cluster"]: r for r in K.purity(tie, "c", "y").collect()}
    assert p[0]["dominant_label"] == 1 and p[0]["purity"] == 0.5 and p[1]["size"] == 1
    pts = spark.createDataFrame([(0, 0.0, 0.0), (0, 2.0, 0.0), (1, 5.0, 5.0)], "c int, x double, y double")
    assert {r["cluster"]: r["inertia"] for r in K.inertia(pts, ["x", "y"], "c").collect()} == {0: 2.0, 1: 0.0}


def test_elbow_rules():
    ks = [2, 3, 4, 5, 6]
    inert = [100.0, 60.0, 50.0, 45.0, 42.0]
    assert K.elbow_k(ks, inert, "reference") == 4      # argmax(d2)=0 -> +2
    assert K.elbow_k(ks, inert, "standard") == 3
    assert K.elbow_k([2, 3], [10.0, 5.0]) == 2


def test_kmeans_sweep_and_ward_on_blobs(spark):
    from tabforge.operators.classify import assemble
    rnd = np.random.default_rng(0)
    pts = np.vstack([rnd.normal(c, 0.1, size=(30, 2)) for c in ((0, 0), (5, 5), (0, 5))])
    df = assemble(spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)],
                                        "id long, x double, y double"), ["x", "y"])
    sweep, models = K.kmeans_sweep(df, ks=range(2, 6), n_init=2)
    assert K.best_silhouette_k(sweep) == 3
    w = K.ward(df, ["id"], n_clusters=3)
    sizes = sorted(r["count"] for r in w.labels.groupBy("cluster").count().collect())
    assert sizes == [30, 30, 30]
    w2 = K.ward(df, ["id"], n_clusters=3, n_micro=20)
    assert sorted(r["count"] for r in w2.labels.groupBy("cluster").count().collect()) == [30, 30, 30]
    _ = F


def exact_labels(x, k):
    return K.cut_linkage(K.ward_linkage(x, np.ones(len(x))), len(x), k)


def rand_index(a, b):
    """Adjusted Rand index of two labelings."""
    from collections import Counter
    pairs = lambda c: sum(v * (v - 1) / 2 for v in c.values())
    both, one, two = pairs(Counter(zip(a, b))), pairs(Counter(a)), pairs(Counter(b))
    mean = one * two / (len(a) * (len(a) - 1) / 2)
    return (both - mean) / ((one + two) / 2 - mean)


@pytest.mark.parametrize("spread,limit,least", [(0.5, 64, 0.99), (1.0, 64, 0.9), (1.0, 24, 0.9)])
def test_features_agree_with_an_exact_linkage(spark, spread, limit, least):
    from tabforge.operators.classify import assemble
    r = np.random.default_rng(11)
    centres = r.normal(size=(5, 4)) * 6
    x = np.vstack([c + r.normal(size=(n, 4)) * spread for c, n in zip(centres, (200, 150, 120, 90, 40))])
    df = assemble(spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], ["id", "a", "b", "c", "d"]).repartition(7, "id"), ["a", "b", "c", "d"])
    w = K.ward(df, ["id"], n_clusters=5, n_micro=limit)
    assert w.micro <= limit
    got = [y["cluster"] for y in w.labels.orderBy("id").collect()]
    assert rand_index(got, list(exact_labels(x, 5))) >= least


def test_features_add_up():
    from tabforge.operators import cfeatures as CF
    r = np.random.default_rng(2)
    x = np.vstack([r.normal(size=(3000, 3)), np.full((500, 3), 7.0)])
    parts = [CF.insert(CF.Features(np.zeros(0), np.zeros((0, 3)), np.zeros(0)), CF.Features.of_rows(p), 40) for p in np.array_split(x, 6)]
    whole = CF.merge(parts, 40)
    assert len(whole.n) <= 40 and whole.n.sum() == len(x)
    assert whole.s.sum(0) == pytest.approx(x.sum(0)) and whole.q.sum() == pytest.approx((x ** 2).sum())
    inside = (whole.q - (whole.s ** 2).sum(1) / whole.n).sum()
    assert inside < 0.2 * ((x - x.mean(0)) ** 2).sum()           # what the summary loses
    assert len(CF.merge([], 5).n) == 0


def test_kmeans_fits_share_their_passes(spark):
    """Settled fits as good as Spark's own, with far fewer jobs than one fit after the other."""
    from pyspark.ml.clustering import KMeans
    from tabforge.operators.classify import assemble
    r = np.random.default_rng(8)
    x = np.vstack([r.normal(c, 1.0, size=(60, 3)) for c in ((0, 0, 0), (4, 0, 1), (0, 5, 0), (3, 3, 3))])
    df = assemble(spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], ["id", "a", "b", "c"]).repartition(3, "id"), ["a", "b", "c"])
    ks, n_init = range(2, 8), 5
    spark.sparkContext.setJobGroup("sweep", "sweep")
    sweep, models = K.kmeans_sweep(df, ks=ks, n_init=n_init, parallelism=1)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("sweep"))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs < 40 * len(ks) + 60                             # n_init x len(ks) fits of Spark take over 500
    for row in sweep.collect():
        c = np.array(models[row["k"]].clusterCenters())
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        assert row["inertia"] == pytest.approx(d.min(1).sum(), rel=1e-9)
        assert all(np.abs(x[d.argmin(1) == j].mean(0) - c[j]).max() < 1e-5 for j in range(len(c)))      # settled
        own = min(KMeans(k=row["k"], seed=42 + s, maxIter=300, tol=1e-6).fit(df).summary.trainingCost for s in range(n_init))
        assert row["inertia"] <= own * 1.03
    few = assemble(spark.createDataFrame([(1.0,), (2.0,), (2.0,)], ["a"]), ["a"])
    assert K.kmeans_sweep(few, ks=[2], n_init=1)[0].first()["inertia"] == 0.0


def test_spaces_share_their_passes(spark, monkeypatch):
    """Fits in two vector columns of the same rows: the fits of each column alone, in as many passes as the longer one takes."""
    from pyspark.ml.functions import array_to_vector

    from tabforge.operators import kmeans as KM
    r = random.Random(8)
    rows = [(i, [r.gauss(3 * (i % 4), 1) for _ in range(5)], [r.gauss(i % 3, 1) for _ in range(2)]) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, u array<double>, v array<double>").select("id", array_to_vector("u").alias("u"), array_to_vector("v").alias("v")).cache()
    passes, inner = [], KM.sums_of
    monkeypatch.setattr(KM, "sums_of", lambda *a: passes.append(1) or inner(*a))
    grid, took, alone = [(2, 1), (4, 1), (4, 2)], [], []
    for space in ("u", "v"):
        passes.clear()
        alone.append(KM.fit_all(df, grid, space))
        took.append(len(passes))
    passes.clear()
    for both, own in zip(KM.fit_spaces(df, grid, ["u", "v"]), alone):
        for a, b in zip(both, own):
            assert (a.k, a.seed) == (b.k, b.seed) and np.allclose(a.centres, b.centres) and a.inertia == pytest.approx(b.inertia)
    assert len(passes) == max(took) < sum(took)
    x = np.array([row[1] for row in rows])
    for f in alone[0]:                                       # settled centres are the means of their rows
        at = ((x[:, None] - f.centres[None]) ** 2).sum(2).argmin(1)
        assert np.allclose(f.centres, [x[at == c].mean(0) for c in range(f.k)], atol=1e-5)
        assert f.inertia == pytest.approx(((x - f.centres[at]) ** 2).sum())

"""Clustering and cluster comparison.

* K-means sweep: all k and seeds in the same passes (:mod:`kmeans`), their
  summed squared distances, and Spark's model of the best centres; silhouette by
  ``ClusteringEvaluator`` (squared-Euclidean form, linear in rows).
* Agglomeration: clustering features (at most ``n_micro`` at every table size)
  from one pass over the rows, then a size-weighted linkage (Lance-Williams) of
  their centres on the driver.
* Inertia, ARI and purity are aggregates over (cluster, label) counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .cfeatures import nearest_centre, summarise
from .common import parallel_map
from .kmeans import fit_spaces


# K2 ------------------------------------------------------------------------
def _model(spark: SparkSession, centres: np.ndarray, features: str) -> KMeansModel:
    """Spark's model of these centres: fitted on them alone, each is its own cluster."""
    rows = spark.createDataFrame([(DenseVector(c),) for c in np.unique(centres, axis=0)], [features])
    return KMeans(k=max(2, rows.count()), initMode="random", seed=0, featuresCol=features, predictionCol="cluster", maxIter=1).fit(rows)


def kmeans_sweep(df: DataFrame, ks=range(2, 11), n_init: int = 10, seed: int = 42,
                 features: str = "features", max_iter: int = 300,
                 parallelism: int = 4) -> tuple[DataFrame, dict]:
    """(k, inertia, silhouette) per k, best of ``n_init`` seeds by inertia; also
    the models."""
    return kmeans_sweeps(df, [features], ks, n_init, seed, max_iter, parallelism)[0]


def kmeans_sweeps(df: DataFrame, spaces: list[str], ks=range(2, 11), n_init: int = 10, seed: int = 42, max_iter: int = 300,
                  parallelism: int = 4) -> list[tuple[DataFrame, dict]]:
    """The sweep in each vector column of ``spaces``.  All space x k x seed fits
    share their passes over the rows (:func:`kmeans.fit_spaces`); the
    silhouettes run ``parallelism`` at a time."""
    spark = df.sparkSession
    best: dict = {}
    for space, fits in zip(spaces, fit_spaces(df, [(k, seed + s) for k in ks for s in range(n_init)], spaces, max_iter, tol=1e-6)):
        for f in fits:
            if (space, f.k) not in best or f.inertia < best[space, f.k].inertia:
                best[space, f.k] = f
    models = {at: _model(spark, f.centres, at[0]) for at, f in best.items()}

    def silhouette(at):
        return ClusteringEvaluator(featuresCol=at[0], predictionCol="cluster").evaluate(models[at].transform(df))

    sils = dict(zip(models, parallel_map(silhouette, list(models), parallelism)))
    out = []
    for space in spaces:
        rows = [(int(k), best[s, k].inertia, float(sils[s, k])) for s, k in models if s == space]
        out.append((spark.createDataFrame(rows, "k int, inertia double, silhouette double"), {k: m for (s, k), m in models.items() if s == space}))
    return out


# K3 ------------------------------------------------------------------------
def elbow_k(ks: list[int], inertias: list[float], mode: str = "reference") -> int:
    """argmax of second differences of inertia.  ``reference`` indexes with +2
    (one past the bend, as the reference does); ``standard`` with +1.
    Fewer than 3 points -> first k; index out of range -> middle k."""
    if len(inertias) < 3:
        return ks[0]
    d2 = np.diff(np.diff(np.asarray(inertias, dtype=float)))
    idx = int(np.argmax(d2)) + (2 if mode == "reference" else 1)
    return ks[idx] if idx < len(ks) else ks[len(ks) // 2]


def best_silhouette_k(sweep: DataFrame) -> int:
    return sweep.agg(F.max_by("k", F.struct("silhouette", -F.col("k")))).first()[0]


# K4 ------------------------------------------------------------------------
LINKAGES = ("ward", "complete", "average", "single")


def agglomerate(centroids: np.ndarray, sizes: np.ndarray, linkage: str = "ward") -> np.ndarray:
    """Size-weighted linkage of weighted points (rows: a, b, distance, size).

    ``ward`` works on squared distances scaled by the cluster sizes, the others
    on Euclidean distances; all are updated by their Lance-Williams rule."""
    if linkage not in LINKAGES:
        raise ValueError(f"linkage must be one of {LINKAGES}")
    n = len(sizes)
    size = sizes.astype(float).copy()
    norm = (centroids ** 2).sum(1)
    d = np.maximum(norm[:, None] + norm[None, :] - 2 * centroids @ centroids.T, 0.0)
    d = d * (2 * size[:, None] * size[None, :] / (size[:, None] + size[None, :])) if linkage == "ward" else np.sqrt(d)
    np.fill_diagonal(d, np.inf)
    ids = np.arange(n)
    out = np.zeros((max(n - 1, 0), 4))
    for step in range(n - 1):
        i, j = sorted(divmod(int(np.argmin(d)), n))
        dij, ni, nj = d[i, j], size[i], size[j]
        out[step] = (min(ids[i], ids[j]), max(ids[i], ids[j]), np.sqrt(max(dij, 0.0)) if linkage == "ward" else dij, ni + nj)
        if linkage == "ward":
            new = ((ni + size) * d[i] + (nj + size) * d[j] - size * dij) / (ni + nj + size)
        elif linkage == "average":
            new = (ni * d[i] + nj * d[j]) / (ni + nj)
        else:
            new = np.maximum(d[i], d[j]) if linkage == "complete" else np.minimum(d[i], d[j])
        gone = np.isinf(d[i]) | np.isinf(d[j])
        new[gone] = np.inf
        d[i, :] = d[:, i] = new
        d[i, i] = np.inf
        d[j, :] = d[:, j] = np.inf
        size[i] = ni + nj
        ids[i] = n + step
    return out


def ward_linkage(centroids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return agglomerate(centroids, sizes, "ward")


def cut_linkage(linkage: np.ndarray, n: int, n_clusters: int) -> np.ndarray:
    """Labels 0..n_clusters-1 for the n leaves after n - n_clusters merges
    (label order = order of each cluster's smallest leaf)."""
    parent = list(range(2 * n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for step in range(max(n - n_clusters, 0)):
        a, b = int(linkage[step, 0]), int(linkage[step, 1])
        parent[find(a)] = n + step
        parent[find(b)] = n + step
    roots = [find(i) for i in range(n)]
    order = {}
    for r in roots:
        order.setdefault(r, len(order))
    return np.array([order[r] for r in roots])


@dataclass
class WardResult:
    labels: DataFrame           # key..., cluster
    linkage: np.ndarray
    micro: int


def ward(df: DataFrame, key: list[str], n_clusters: int = 2, n_micro: int = 256, features: str = "features",
         linkage: str = "ward") -> WardResult:
    """Agglomerative clustering of at most ``n_micro`` clustering features, which
    one pass over the rows gives; ``n_micro`` bounds what the driver holds
    (n_micro^2 distances).  A second pass gives each row its nearest feature's cluster."""
    micro = summarise(df, features, n_micro)
    link = agglomerate(micro.centres, micro.n, linkage)
    lab = F.lit(None).cast("int")
    if len(micro.n):
        of = F.array(*[F.lit(int(c)) for c in cut_linkage(link, len(micro.n), n_clusters)])     # at most n_micro numbers
        lab = of[nearest_centre(micro.centres)(features)]
    return WardResult(df.withColumn("cluster", lab), link, len(micro.n))


# K10 -----------------------------------------------------------------------
def dendrogram(spark: SparkSession, linkage: np.ndarray, last: int = 30) -> DataFrame:
    rows = [(i, int(a), int(b), float(d), int(s)) for i, (a, b, d, s) in enumerate(linkage)]
    df = spark.createDataFrame(rows, "step int, a int, b int, distance double, size int")
    return df.orderBy(F.desc("step")).limit(last)


# K5 ------------------------------------------------------------------------
def inertia(df: DataFrame, cols: list[str], cluster: str) -> DataFrame:
    """Sum of squared distances to the cluster means, per cluster and total:
    per cluster sum_dims var_pop * count (one aggregate)."""
    per = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"),
        sum(F.coalesce(F.var_pop(F.col(c).cast("double")), F.lit(0.0)) for c in cols).alias("_v"))
    return per.select(F.col(cluster).alias("cluster"), "size", (F.col("_v") * F.col("size")).alias("inertia"))


# K6 ------------------------------------------------------------------------
#: Query vectors that are sent to all tasks at once.
QUERY_BLOCK = 20_000
#: Queries and rows whose distances a task holds at once.
TILE = 1024


def silhouettes(df: DataFrame, key: str, vector: str, cluster: str, queries=None, block: int = QUERY_BLOCK) -> DataFrame:
    """(key, cluster, a, b, silhouette): the exact Euclidean silhouette of the
    rows of ``queries`` (a condition; default: every 20th key) against all rows.

    a is the mean distance to the other rows of the own cluster, b the smallest
    mean distance to another cluster, silhouette (b - a) / max(a, b), and 0 in a
    cluster of one.  Blocks of query vectors travel to the tasks, which add up
    their rows' distances per cluster: only (query, cluster, sum, count) leave a
    task.  Rows whose vector or cluster is NULL take part in nothing."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(cluster).alias("c"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter("c IS NOT NULL AND v IS NOT NULL AND id IS NOT NULL")
    asked = rows.filter((F.col("id") % 20 == 0) if queries is None else queries)
    kind = rows.schema["c"].dataType.simpleString()
    n_blocks = -(-asked.count() // block)
    sums = df.sparkSession.createDataFrame([], f"q int, block int, of {kind}, s double, n long")
    names = df.sparkSession.createDataFrame([], f"q int, block int, id long, c {kind}")
    for i in range(n_blocks):
        # about ``block`` rows, dealt by a hash of the key
        some = asked.filter(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == i).orderBy("id").collect()
        if not some:
            continue
        q = np.array([r["v"] for r in some], float)
        ids = np.array([r["id"] for r in some], np.int64)

        def run(batches, q=q, ids=ids):
            import pyarrow as pa

            norm = (q * q).sum(1)
            total: dict = {}
            kind_ = None
            for b in batches:
                kind_ = b.schema.field(1).type
                for lo in range(0, b.num_rows, TILE):
                    part = b.slice(lo, TILE)
                    x = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                    labels, own = np.array(part.column(1).to_pylist(), object), part.column(0).to_numpy()
                    on = {c: np.flatnonzero(labels == c) for c in set(labels.tolist())}
                    for c, at in on.items():
                        s, n = total.get(c, (None, 0))
                        total[c] = np.zeros(len(q)) if s is None else s, n + len(at)
                    for of in range(0, len(q), TILE):        # a tile of distances at a time, whatever the block and the batch
                        mine = slice(of, of + TILE)
                        d = np.sqrt(np.maximum(norm[mine, None] + (x * x).sum(1)[None] - 2 * (q[mine] @ x.T), 0.0))
                        d[ids[mine, None] == own[None]] = 0.0
                        for c, at in on.items():
                            total[c][0][mine] += d[:, at].sum(1)
            for c, (s, n) in total.items():
                m = len(q)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(m, dtype=np.int32)), pa.array([c] * m, kind_), pa.array(s), pa.array([n] * m, pa.int64())],
                                                 names=["q", "of", "s", "n"])

        part = rows.repartition(max(1, df.sparkSession.sparkContext.defaultParallelism)).mapInArrow(run, f"q int, of {kind}, s double, n long")
        part = part.groupBy("q", "of").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        sums = sums.unionByName(materialize(part.withColumn("block", F.lit(i)), "distance-sums"))
        names = names.unionByName(df.sparkSession.createDataFrame([(j, i, r["id"], r["c"]) for j, r in enumerate(some)], names.schema))
    both = sums.join(names, ["block", "q"])
    own = F.col("of") == F.col("c")
    per = both.groupBy("id", "c", "block", "q").agg(
        F.max(F.when(own, F.col("s") / F.nullif(F.col("n") - 1, F.lit(0)))).alias("a"), F.min(F.when(~own, F.col("s") / F.col("n"))).alias("b"))
    value = F.when(F.col("a").isNull(), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return per.select(F.col("id").alias(key), F.col("c").alias(cluster), "a", "b", value.alias("silhouette"))


# K7 ------------------------------------------------------------------------
def ari(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index from the contingency table (one row)."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("n"))
    comb = lambda x: x * (x - 1) / 2
    # cell, row and column counts tagged and stacked, then ONE aggregate (no joins)
    parts = cells.select(F.lit("ij").alias("kind"), "n").unionByName(
        cells.groupBy(a).agg(F.sum("n").alias("n")).select(F.lit("a").alias("kind"), "n")).unionByName(
        cells.groupBy(b).agg(F.sum("n").alias("n")).select(F.lit("b").alias("kind"), "n"))
    t = parts.agg(*[F.sum(F.when(F.col("kind") == kd, comb(F.col("n")))).alias(nm)
                    for kd, nm in (("ij", "sij"), ("a", "sa"), ("b", "sb"))],
                  F.sum(F.when(F.col("kind") == "ij", F.col("n"))).alias("tot"))
    e = F.col("sa") * F.col("sb") / comb(F.col("tot"))
    return t.select(((F.col("sij") - e) / ((F.col("sa") + F.col("sb")) / 2 - e)).alias("ari"))


# K8 ------------------------------------------------------------------------
def purity(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Per cluster: dominant label (ties -> smallest), its share, and size."""
    cells = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(cluster).orderBy(F.desc("n"), F.asc(label))
    top = cells.withColumn("_r", F.row_number().over(w))
    size = cells.groupBy(cluster).agg(F.sum("n").alias("size"))
    return (top.filter("_r = 1").join(size, cluster)
               .select(F.col(cluster).alias("cluster"), F.col(label).alias("dominant_label"),
                       (F.col("n") / F.col("size")).alias("purity"), "size"))

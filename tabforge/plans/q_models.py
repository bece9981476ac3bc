"""ML queries (rows-only: iterative fits have no SQL form) and the SQL-checkable
cluster-agreement queries (K5, K7, K8).

F1, F2, F7-F9, X1-X5, M2-M9, K2-K4, K6, H2-H4, R1-R7, Z1, Z8, ST1, S1-S10.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregate as G
from ..operators import classify as M
from ..operators import clean as C
from ..operators import cluster as K
from ..operators import metrics as V
from ..operators import pca as X
from ..operators import score as Z
from ..operators import select as SEL
from ..operators import split as S
from ..operators import tune as H
from ..operators.registry import ModelRegistry
from ..session import materialize, scratch_path
from ..sources import files as IO
from ..sources.tables import ORDERLINES, orderlines, read_table, vectors
from ..streaming.scoring import score_stream
from .catalog import query
from .q_clean import OL_NUM, cleaned_orderlines
from .q_score import ORDERLINE_LABELS, ORDERLINE_REQUEST_RULES, ORDERLINE_RULES
from .sqlparts import OL_CLEAN_CHAIN, r6, with_

OL_CAT = ["l_returnflag", "l_linestatus", "l_linenumber"]
OL_FEATS = OL_NUM + OL_CAT


def ml_frame(spark, sf_dir) -> tuple[DataFrame, object]:
    """Cleaned, encoded orderlines with stratified split and folds, features
    scaled with statistics of the train rows and assembled, and the label.

    The line number is a feature and part of the key, so the frame's key holds
    a copy of it (``line_key``) that is not scaled."""
    raw, spec = orderlines(spark, sf_dir)
    cl, levels = C.clean_with_levels(raw, spec)
    # a projection of the coerced table, which is written: split, folds and scaler read that
    df = S.add_folds(S.add_split(C.encode(cl, spec, levels)[0], spec), spec)
    stats = C.fit_scaler(df.filter("split = 'train'"), OL_FEATS)
    df = C.scale(df.withColumn("line_key", F.col("l_linenumber")), OL_FEATS, stats)
    df = M.assemble(df, OL_FEATS).withColumn("label", F.col(spec.target).cast("double"))
    # one part for every core and more: the fits' passes read this table
    df = df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "l_orderkey")
    return materialize(df, "ml-frame"), spec.with_(key=("l_orderkey", "line_key"))


def _test_metrics(name: str, model, test: DataFrame) -> DataFrame:
    p = materialize(M.predictions(model, test), "test-scores")       # told once, read by every metric
    bm = V.binary_metrics(p, "y", "pred")
    au = V.auc_ap(p, "y", "s")
    both = bm.unionByName(au, allowMissingColumns=True)      # two one-row frames, no join
    return both.agg(*[F.max(c).alias(c) for c in bm.columns + au.columns]).select(
        F.lit(name).alias("model"), "*")


def _model_query(name: str, **params):
    def run(spark, sf_dir):
        df, spec = ml_frame(spark, sf_dir)
        train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
        t = M.fit_model(name, train, list(spec.key), **params)
        return _test_metrics(name, t.model, test)
    return run


query("logreg")(_model_query("logistic_regression"))
query("dtree")(_model_query("decision_tree"))
query("rforest")(_model_query("random_forest"))
query("svm")(_model_query("svm", kernel="rbf"))


@query("svm_linear")
def q_svm_linear(spark, sf_dir):
    df, spec = ml_frame(spark, sf_dir)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    return _test_metrics("svm_linear", M.fit_model("svm", train, list(spec.key), kernel="linear").model, test)


@query("cv_models")
def q_cv_models(spark, sf_dir):
    """M7/V9: 5-fold CV of every model; per-fold metrics from one grouped pass per model."""
    df, spec = ml_frame(spark, sf_dir)
    out = None
    for name in M.MODEL_NAMES:
        cv = M.cross_validate(df, name, list(spec.key), shared=False).select(F.lit(name).alias("model"), "*")
        out = cv if out is None else out.unionByName(cv)
    return out


@query("model_summary")
def q_model_summary(spark, sf_dir):
    """M6 + M8: train all four models with defaults, summary table (4-dp strings)."""
    df, spec = ml_frame(spark, sf_dir)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    models = M.train_all(train, list(spec.key))
    t = None
    for name, tr in models.items():
        m = _test_metrics(name, tr.model, test)
        t = m if t is None else t.unionByName(m)
    return t.select("model", *[F.format_string("%.4f", c).alias(c)
                               for c in ("accuracy", "precision", "recall", "f1", "roc_auc")])


@query("rf_importance")
def q_rf_importance(spark, sf_dir):
    df, spec = ml_frame(spark, sf_dir)
    return SEL.rf_importance(df, OL_FEATS, "label")


@query("rfe")
def q_rfe(spark, sf_dir):
    df, spec = ml_frame(spark, sf_dir)
    return SEL.rfe(df, OL_FEATS, "label")[0]


@query("compare_selectors")
def q_compare_selectors(spark, sf_dir):
    df, spec = ml_frame(spark, sf_dir)
    sel, comp = SEL.compare_selectors(df, OL_NUM, OL_CAT, "label", k=4, key=spec.key)
    best = SEL.best_method(comp)
    return comp.withColumn("is_best", F.col("method") == F.lit(best))


@query("impact")
def q_impact(spark, sf_dir):
    """Impact levels of the trained forest's importances (last pipeline stage)."""
    df, spec = ml_frame(spark, sf_dir)
    t = M.fit_model("random_forest", df.filter("split = 'train'"), list(spec.key))
    imp = M.importances(t.model, OL_FEATS)
    return Z.feature_impact(spark, [n for n, _ in imp], [v for _, v in imp], top=8)


# PCA -----------------------------------------------------------------------
@query("pca_variance")
def q_pca_variance(spark, sf_dir):
    """Variance table with components-needed per threshold attached."""
    df, spec = vectors(spark, sf_dir)
    r = X.fit_pca(df, list(spec.numeric))
    th = {t: r.n_for(t) for t in X.THRESHOLDS}
    vt = X.variance_table(spark, r)
    return vt.select("*", *[F.lit(v).cast("int").alias(f"n_for_{int(t * 100)}") for t, v in th.items()])


@query("pca_report")
def q_pca_report(spark, sf_dir):
    """The report's recommendation rules applied to the fitted components."""
    df, spec = vectors(spark, sf_dir)
    r = X.fit_pca(df, list(spec.numeric))
    rows = X.recommendations(r) or [("none", "no recommendation rule applies")]
    return spark.createDataFrame(rows, "rule string, text string")


@query("pca_loadings")
def q_pca_loadings(spark, sf_dir):
    df, spec = vectors(spark, sf_dir)
    return X.top_loadings(spark, X.fit_pca(df, list(spec.numeric)), n=5)


@query("pca_table")
def q_pca_table(spark, sf_dir):
    """X4 + S10: PC1..PC10 (+ key, label) for every row."""
    df, spec = vectors(spark, sf_dir)
    r = X.fit_pca(df, list(spec.numeric))
    return X.pca_columns(df, r, m=10, keep=["vec_id", "label"])


_PCA_DIMS = [f"e{i:02d}" for i in range(64)]


@query("pca_covariance", f"""WITH z AS (SELECT {', '.join(f'CAST(embedding[{i + 1}] AS DOUBLE) AS {c}' for i, c in enumerate(_PCA_DIMS))} FROM embeddings)
SELECT a, b, {r6('c')} AS covariance, {r6('CAST(a = b AS INTEGER)')} AS dot FROM (
""" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, covar_samp({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) AS c FROM z"
    for i, a in enumerate(_PCA_DIMS) for b in _PCA_DIMS[i:]) + ")")
def q_pca_covariance(spark, sf_dir):
    """The fitted components put together again.  Per pair of features the
    sum over components of variance x loading x loading, which is the covariance
    of the standardised features, and the dot product of the features' loadings,
    which is 1 for a feature with itself and 0 otherwise."""
    df, spec = vectors(spark, sf_dir)
    r = X.fit_pca(df, list(spec.numeric))
    load = X.loadings(spark, r)
    var = X.variance_table(spark, r).select("component", "explained_variance")
    one = load.join(var, "component").select("component", F.col("feature").alias("a"), F.col("loading").alias("x"), "explained_variance")
    two = load.select("component", F.col("feature").alias("b"), F.col("loading").alias("y"))
    both = one.join(two, "component").filter("a <= b")               # 64 x 64 / 2 pairs a component
    return both.groupBy("a", "b").agg(F.sum(F.col("explained_variance") * F.col("x") * F.col("y")).alias("covariance"),
                                      F.sum(F.col("x") * F.col("y")).alias("dot"))


# Clustering ----------------------------------------------------------------
VECTORS_A_PART = 4096


def _vec_frame(spark, sf_dir):
    df, spec = vectors(spark, sf_dir)
    st = C.fit_scaler(df, list(spec.numeric))
    z = M.assemble(C.scale(df, list(spec.numeric), st), list(spec.numeric))
    # as many parts as the rows are worth: a pass over few thousand vectors costs more to spread than to run
    most = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    z = z.repartition(max(1, min(most, -(-df.count() // VECTORS_A_PART))), *spec.key)
    return materialize(z, "vectors"), spec


@query("kmeans_sweep")
def q_kmeans_sweep(spark, sf_dir):
    """K2/K3/K6: inertia + silhouette per k, elbow (reference rule) and best-silhouette flags."""
    z, spec = _vec_frame(spark, sf_dir)
    sweep, _ = K.kmeans_sweep(z)
    rows = sweep.orderBy("k").collect()
    ek = K.elbow_k([r["k"] for r in rows], [r["inertia"] for r in rows])
    sk = K.best_silhouette_k(sweep)
    return sweep.select("*", (F.col("k") == ek).alias("elbow"), (F.col("k") == sk).alias("best_silhouette"))


@query("kmeans_assign")
def q_kmeans_assign(spark, sf_dir):
    """K11 + J1 + G11 + K7 + K8: best-silhouette k, labels joined on the row
    key, cluster sizes, purity and ARI against the true label."""
    z, spec = _vec_frame(spark, sf_dir)
    sweep, models = K.kmeans_sweep(z)
    k = K.best_silhouette_k(sweep)
    lab = models[k].transform(z).select("vec_id", "cluster")
    joined = z.select("vec_id", "label").join(lab, "vec_id")     # J1: equi-join on key
    pur = K.purity(joined, "cluster", "label")
    a = K.ari(joined, "cluster", "label").first()["ari"]
    return pur.withColumn("k", F.lit(k)).withColumn("ari", F.lit(a))


@query("kmeans_rule", """SELECT 10 AS k, vec_id, TRUE AS nearest, TRUE AS settled FROM embeddings""")
def q_kmeans_rule(spark, sf_dir):
    """Every row is in the cluster whose written centre is nearest by a
    plain distance expression (equal ones allowed), and every centre is the mean
    of its rows (the fit has settled)."""
    z, spec = _vec_frame(spark, sf_dir)
    _, models = K.kmeans_sweep(z, ks=[10], n_init=2)
    rows = models[10].transform(z).select("vec_id", vector_to_array("features").alias("v"), "cluster")
    centres = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(models[10].clusterCenters())], "c int, centre array<double>")   # ten rows
    pairs = [(r["c"], r["centre"]) for r in centres.orderBy("c").collect()]

    def square(centre):
        return F.aggregate(F.zip_with("v", centre, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda x, y: x + y)

    table = F.transform(F.array(*[F.array(*[F.lit(float(x)) for x in c]) for _, c in pairs]), square)
    means = rows.groupBy("cluster").agg(F.array(*[F.avg(F.col("v")[j]) for j in range(len(pairs[0][1]))]).alias("mean")).collect()
    settled = {m["cluster"]: max(abs(a - b) for a, b in zip(m["mean"], dict(pairs)[m["cluster"]])) < 1e-4 for m in means}
    flags = F.create_map(*[x for c, ok in settled.items() for x in (F.lit(c), F.lit(ok))])
    told = rows.withColumn("d", table)
    return told.select(F.lit(10).alias("k"), "vec_id", (F.col("d")[F.col("cluster")] <= F.array_min("d") + 1e-9).alias("nearest"),
                       flags[F.col("cluster")].alias("settled"))


@query("ward")
def q_ward(spark, sf_dir):
    """Ward clustering over micro-clusters, cluster sizes, ARI vs label and the last merges of the dendrogram."""
    z, spec = _vec_frame(spark, sf_dir)
    w = K.ward(z, ["vec_id"], n_clusters=10)
    a = K.ari(w.labels, "cluster", "label").first()["ari"]
    sizes = G.group_sizes(w.labels, "cluster")
    return sizes.withColumn("ari", F.lit(a)).withColumn("micro_clusters", F.lit(w.micro))


@query("compare_clusterings")
def q_compare_clusterings(spark, sf_dir):
    """K9: K-means vs Ward, on the original (standardised) features and on the
    first 10 principal components: silhouette and ARI against the label."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    z, spec = _vec_frame(spark, sf_dir)
    r = X.fit_pca(z.drop("features"), list(spec.numeric))
    z = z.withColumnRenamed("features", "original")
    both = M.assemble(X.pca_columns(z, r, m=10, keep=["vec_id", "label", "original"]), [f"PC{j + 1}" for j in range(10)])
    both = materialize(both.withColumnRenamed("features", "pca10"), "components")
    rows = []
    for space, (sweep, models) in zip(("original", "pca10"), K.kmeans_sweeps(both, ["original", "pca10"], ks=[10])):
        wd = K.ward(both, ["vec_id"], n_clusters=10, features=space).labels
        ward = ClusteringEvaluator(featuresCol=space, predictionCol="cluster").evaluate(wd)
        for method, lab, s in (("kmeans", models[10].transform(both), sweep.first()["silhouette"]), ("ward", wd, ward)):
            rows.append((space, method, float(s), float(K.ari(lab, "cluster", "label").first()[0])))
    return spark.createDataFrame(rows, "space string, method string, silhouette double, ari double")


@query("dendrogram")
def q_dendrogram(spark, sf_dir):
    z, spec = _vec_frame(spark, sf_dir)
    w = K.ward(z, ["vec_id"], n_clusters=10)
    return K.dendrogram(spark, w.linkage, last=30)


@query("silhouette")
def q_silhouette(spark, sf_dir):
    """K6: squared-Euclidean silhouette of the true labels."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    z, spec = _vec_frame(spark, sf_dir)
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="label")
    return spark.createDataFrame([(float(ev.evaluate(z)),)], "silhouette double")


@query("silhouette_exact", f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT q.vec_id, q.label, r.label AS other, sum(CASE WHEN q.vec_id = r.vec_id THEN 0 ELSE list_distance(q.v, r.v) END) AS s, count(*) AS n
  FROM e q JOIN e r ON q.vec_id % 20 = 0 GROUP BY ALL),
ab AS (SELECT vec_id, label, max(CASE WHEN other = label AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN other <> label THEN s / n END) AS b
  FROM d GROUP BY ALL)
SELECT vec_id, label, {r6('a')} AS a, {r6('b')} AS b,
  {r6('CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END')} AS silhouette FROM ab""")
def q_silhouette_exact(spark, sf_dir):
    """K6: the Euclidean silhouette of every 20th vector against all vectors, true labels as clusters."""
    return K.silhouettes(read_table(spark, sf_dir, "embeddings", ["vec_id", "label", "embedding"]), "vec_id", "embedding", "label")


@query("cv_summary")
def q_cv_summary(spark, sf_dir):
    """V9: mean and standard deviation of the five metrics over the folds."""
    df, spec = ml_frame(spark, sf_dir)
    return M.cv_summary(M.cross_validate(df, "logistic_regression", list(spec.key)), "logistic_regression")


@query("attach_clusters", "SELECT vec_id, label, CAST(label % 4 AS INTEGER) AS cluster FROM embeddings")
def q_attach_clusters(spark, sf_dir):
    """S8 + J1: an assignment table, written and read back, joined on the row key."""
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "label"])
    path = scratch_path(spark, f"assignments-{uuid.uuid4().hex[:8]}")
    IO.save(e.select("vec_id", (F.col("label") % 4).cast("int").alias("cluster")), path)
    return e.join(IO.load_typed(spark, path, "vec_id long, cluster int", fmt="parquet"), "vec_id")


_N_DIMS = 64                                                 # components of an embedding


@query("elbow", f"""WITH g AS (SELECT t.k, vec_id % t.k AS c, embedding AS e FROM embeddings CROSS JOIN range(2, 11) t(k)),
i AS (SELECT k, c, ({' + '.join(f'var_pop(CAST(e[{d + 1}] AS DOUBLE))' for d in range(_N_DIMS))}) * count(*) AS w FROM g GROUP BY k, c),
s AS (SELECT k, sum(w) AS inertia FROM i GROUP BY k),
d AS (SELECT k, inertia, inertia - 2 * lag(inertia, 1) OVER (ORDER BY k) + lag(inertia, 2) OVER (ORDER BY k) AS bend FROM s)
SELECT CAST(k AS INTEGER) AS k, {r6('inertia')} AS inertia, {r6('bend')} AS bend,
       k = (SELECT k FROM d WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1) AS elbow FROM d""")
def q_elbow(spark, sf_dir):
    """K3 + W5: inertia of the groupings by id modulo k, and the elbow rule on it."""
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    dims = [F.col("embedding")[d].cast("double").alias(f"e{d}") for d in range(_N_DIMS)]
    rows = e.select("vec_id", *dims).withColumn("k", F.explode(F.sequence(F.lit(2), F.lit(10))))
    per = rows.groupBy("k", (F.col("vec_id") % F.col("k")).alias("c")).agg(
        F.count(F.lit(1)).alias("size"), sum(F.var_pop(f"e{d}") for d in range(_N_DIMS)).alias("v"))
    sweep = per.groupBy("k").agg(F.sum(F.col("v") * F.col("size")).alias("inertia"))
    table = sweep.orderBy("k").collect()                      # one row per k
    ks, inertias = [r["k"] for r in table], [r["inertia"] for r in table]
    best = K.elbow_k(ks, inertias) if ks else None
    from pyspark.sql import Window
    w = Window.orderBy("k")                                   # nine rows
    bend = F.col("inertia") - 2 * F.lag("inertia", 1).over(w) + F.lag("inertia", 2).over(w)
    return sweep.select("k", "inertia", bend.alias("bend"), (F.col("k") == F.lit(best)).alias("elbow"))


# SQL-checkable cluster agreement ----------------------------------------------
_DIMS = _PCA_DIMS
_EMB = "emb AS (SELECT vec_id, label, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(_DIMS)) + " FROM embeddings)"


@query("inertia", with_(_EMB) + f"""SELECT label AS cluster, count(*) AS size,
  {r6('(' + ' + '.join(f'coalesce(var_pop({c}), 0)' for c in _DIMS) + ') * count(*)')} AS inertia
FROM emb GROUP BY label""")
def q_inertia(spark, sf_dir):
    """K5: within-group sum of squares of the embeddings per true label."""
    df, spec = vectors(spark, sf_dir)
    return K.inertia(df, list(spec.numeric), "label")


@query("ari", with_(*OL_CLEAN_CHAIN,
                    "cells AS (SELECT l_returnflag AS a, l_linestatus AS b, CAST(count(*) AS DOUBLE) AS n FROM ol_clean GROUP BY 1, 2)",
                    "sa AS (SELECT sum(n * (n - 1) / 2) AS sa FROM (SELECT sum(n) AS n FROM cells GROUP BY a))",
                    "sb AS (SELECT sum(n * (n - 1) / 2) AS sb FROM (SELECT sum(n) AS n FROM cells GROUP BY b))",
                    "sij AS (SELECT sum(n * (n - 1) / 2) AS sij, sum(n) AS tot FROM cells)") +
       f"SELECT {r6('(sij - sa * sb / (tot * (tot - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (tot * (tot - 1) / 2))')} AS ari "
       "FROM sij CROSS JOIN sa CROSS JOIN sb")
def q_ari(spark, sf_dir):
    """K7: agreement of two labelings (return flag vs line status)."""
    cl, _ = cleaned_orderlines(spark, sf_dir)
    return K.ari(cl, "l_returnflag", "l_linestatus")


@query("purity", with_(*OL_CLEAN_CHAIN,
                       "cells AS (SELECT l_returnflag AS cluster, severity AS lab, count(*) AS n FROM ol_clean GROUP BY 1, 2)",
                       "r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, lab) AS rn, "
                       "sum(n) OVER (PARTITION BY cluster) AS size FROM cells)") +
       f"SELECT cluster, lab AS dominant_label, {r6('n / size')} AS purity, size FROM r WHERE rn = 1")
def q_purity(spark, sf_dir):
    """K8: dominant class per group (return flag as the grouping)."""
    cl, spec = cleaned_orderlines(spark, sf_dir)
    return K.purity(cl, "l_returnflag", spec.target)


# Tuning --------------------------------------------------------------------
@query("random_search")
def q_random_search(spark, sf_dir):
    """H2/H4: random search (50 draws, 5 folds) of all four models; report rows."""
    df, spec = ml_frame(spark, sf_dir)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    return H.report(spark, H.search_all(train, test, key=list(spec.key)))


@query("grid_search")
def q_grid_search(spark, sf_dir):
    """H3: exhaustive grid search of all four models over the full grids."""
    df, spec = ml_frame(spark, sf_dir)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    return H.report(spark, H.search_all(train, test, n_iter=None, key=list(spec.key)))


# Registry + scoring ----------------------------------------------------------
def _pipeline_rows(spark, sf_dir) -> tuple[DataFrame, tuple[dict, dict]]:
    """Cleaned rows with split and label, and the medians and modes filled in."""
    raw, spec = orderlines(spark, sf_dir)
    cl, *fills = C.clean_with_fills(raw, spec)
    return S.add_split(cl, spec).withColumn("label", F.col(spec.target).cast("double")), tuple(fills)


def _fit_pipeline(df, max_iter: int = 100):
    """Fitted PipelineModel: string indexing (alphabetical, as T6) -> assembler
    -> logistic regression, so it scores cleaned rows with raw categories."""
    train = df.filter("split = 'train'")
    n = train.count()
    idx = StringIndexer(inputCols=["l_returnflag", "l_linestatus"], outputCols=["rf_idx", "ls_idx"],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    feats = OL_NUM + ["rf_idx", "ls_idx", "l_linenumber"]
    pipe = Pipeline(stages=[idx, M.assembler(feats), M.logistic_regression(n, max_iter=max_iter)])
    return pipe.fit(train)


@query("registry_roundtrip")
def q_registry_roundtrip(spark, sf_dir):
    """R1-R7 + J4: save two versions, list, validate, promote, load latest, export;
    the version history joined to the evaluation summary by model name."""
    root = scratch_path(spark, f"registry-{uuid.uuid4().hex[:8]}")
    reg = ModelRegistry(spark, root)
    df, _ = _pipeline_rows(spark, sf_dir)                    # both versions learn from the same rows
    model = _fit_pipeline(df, max_iter=20)
    test = df.filter("split = 'test'")
    acc = H.test_accuracy(model, test)
    reg.save("logistic_regression", model, {"accuracy": acc}, {"maxIter": 20})
    model2 = _fit_pipeline(df, max_iter=100)
    acc2 = H.test_accuracy(model2, test)
    v2 = reg.save("logistic_regression", model2, {"accuracy": acc2}, {"maxIter": 100})
    assert reg.latest("logistic_regression") == v2
    checks = reg.validate("logistic_regression", v2, test=test, probe=test)
    ok = all(r["ok"] for r in checks.collect())
    reg.promote_best("accuracy")
    reg.load("logistic_regression")
    reg.export("logistic_regression", v2, f"{root}/export")
    summary = spark.createDataFrame([("logistic_regression", ok)], "model_name string, validated boolean")
    return (reg.versions().join(summary, "model_name")
               .select("model_name", "version", "model_type", "n_stages", "size_bytes", "sha256",
                       F.col("metrics")["accuracy"].alias("accuracy"), "validated"))


_VERSIONS = """v AS (SELECT o_orderpriority AS model_name, strftime(max(o_orderdate), '%Y%m%d_000000_000000') AS version,
  avg(o_totalprice) / 1000000 AS accuracy FROM orders GROUP BY o_orderpriority, date_trunc('month', o_orderdate))"""


def _order_versions(spark, sf_dir) -> ModelRegistry:
    """A registry whose rows come from the orders: one model per priority, one version per month."""
    o = read_table(spark, sf_dir, "orders", ["o_orderpriority", "o_orderdate", "o_totalprice"])
    v = o.groupBy("o_orderpriority", F.trunc("o_orderdate", "month")).agg(
        F.max("o_orderdate").alias("at"), (F.avg("o_totalprice") / 1000000).alias("accuracy"))
    reg = ModelRegistry(spark, scratch_path(spark, f"registry-{uuid.uuid4().hex[:8]}"))
    null = F.lit(None)
    reg.import_versions(v.select(
        F.col("o_orderpriority").alias("model_name"), F.date_format("at", "yyyyMMdd_000000_000000").alias("version"),
        F.col("at").cast("timestamp").alias("saved_at"), F.lit("none").alias("model_type"), null.cast("map<string,string>").alias("params"),
        F.create_map(F.lit("accuracy"), F.col("accuracy")).alias("metrics"), F.lit(0).alias("n_stages"),
        F.lit(0).cast("bigint").alias("size_bytes"), null.cast("string").alias("sha256"), null.cast("string").alias("path")))
    return reg


@query("version_history", with_(_VERSIONS) + f"SELECT model_name, version, {r6('accuracy')} AS accuracy FROM v")
def q_version_history(spark, sf_dir):
    """All versions of all models, newest first."""
    return _order_versions(spark, sf_dir).versions().select("model_name", "version", F.col("metrics")["accuracy"].alias("accuracy"))


@query("latest_version", with_(_VERSIONS) + "SELECT model_name, max(version) AS version FROM v GROUP BY model_name")
def q_latest_version(spark, sf_dir):
    """The newest version of every model."""
    return _order_versions(spark, sf_dir).latest_versions()


@query("batch_score")
def q_batch_score(spark, sf_dir):
    """Score every row with a trained pipeline and interpret it."""
    df, _ = _pipeline_rows(spark, sf_dir)
    out = Z.predict(_fit_pipeline(df), df)
    pred = F.col("prediction").cast("int")
    return out.select("l_orderkey", "l_linenumber", pred.alias("prediction"), "confidence",
                      Z.confidence_band(F.col("confidence")).alias("confidence_level"),
                      Z.risk_category(pred).alias("risk_category"),
                      F.array_join(Z.RL.factors(ORDERLINE_RULES.risk), "; ").alias("risk_factors"))


@query("batch_score_known", with_(*OL_CLEAN_CHAIN) + f"""SELECT l_orderkey, l_linenumber, {Z.RL.factors_sql(ORDERLINE_RULES.risk)} AS risk_factors,
  TRUE AS consistent FROM ol_clean""")
def q_batch_score_known(spark, sf_dir):
    """What must hold of the scored rows whatever the model: every cleaned
    row once, its factors, a confidence between 1/2 and 1, and the band and
    category that follow from confidence and class."""
    out = q_batch_score(spark, sf_dir)
    conf = F.col("confidence")
    ok = conf.between(0.5, 1.0) & (F.col("confidence_level") == Z.confidence_band(conf)) & (F.col("risk_category") == Z.risk_category(F.col("prediction")))
    return out.select("l_orderkey", "l_linenumber", "risk_factors", ok.alias("consistent"))


class _CleanThenScore:
    """Stateless per-row cleaning with batch-fitted fill values, then the pipeline."""

    def __init__(self, model, spec, medians, modes):
        self.model, self.spec, self.medians, self.modes = model, spec, medians, modes

    def transform(self, df):
        filled = C.impute_median(C.coerce_numeric(df, self.spec), self.spec, medians=self.medians)
        return self.model.transform(C.impute_mode(filled, self.spec, modes=self.modes))


@query("stream_score")
def q_stream_score(spark, sf_dir):
    """ST1: lineitem file as a stream -> validate -> score -> interpret -> append
    to a parquet history with a checkpoint (availableNow trigger)."""
    # model and cleaning statistics are fitted in batch; the stream applies them row by row
    df, (medians, modes) = _pipeline_rows(spark, sf_dir)
    model, spec = _fit_pipeline(df), ORDERLINES
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex[:8]}")
    li_schema = read_table(spark, sf_dir, "lineitem").schema
    prep = _CleanThenScore(model, spec, medians, modes)
    # a pattern, so that the table may be one file or a folder of files
    q = score_stream(spark, f"{sf_dir}/{{lineitem.parquet}}", li_schema, prep, f"{run}/history", ORDERLINE_RULES,
                     checkpoint=f"{run}/checkpoint", request_rules=ORDERLINE_REQUEST_RULES,
                     labels=ORDERLINE_LABELS)
    q.awaitTermination()
    hist = spark.read.parquet(f"{run}/history")
    return hist.select("l_orderkey", "l_linenumber", F.col("prediction").cast("int").alias("prediction"),
                       "confidence", "confidence_level", "risk_category",
                       F.array_join("risk_factors", "; ").alias("risk_factors"), "error")


@query("io_roundtrip", with_(*OL_CLEAN_CHAIN) +
       f"SELECT {', '.join(f'{r6(c)} AS {c}' for c in OL_NUM)}, severity FROM ol_clean")
def q_io_roundtrip(spark, sf_dir):
    """Write the cleaned table as CSV, reload it with the
    exact-header check and numeric coercion; write rankings partitioned by method."""
    from ..operators import stats as ST
    run = scratch_path(spark, f"io-{uuid.uuid4().hex[:8]}")
    cl, spec = cleaned_orderlines(spark, sf_dir)
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "severity"]
    IO.save(cl.select(*cols), f"{run}/cleaned_csv", fmt="csv")
    back = IO.load_csv_checked(spark, f"{run}/cleaned_csv", cols, target="severity")
    IO.save_rankings({"univariate": ST.anova_f(cl, OL_NUM, spec.target, 2),
                      "chi_square": ST.chi2_scores(cl, OL_NUM, spec.target, 2)}, f"{run}/rankings")
    IO.save_json(V.binary_metrics(cl.withColumn("pred", F.lit(1)), spec.target, "pred"), f"{run}/eval_json")
    return back


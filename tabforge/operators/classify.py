"""Classifiers and cross-validation (M1-M9) on ``pyspark.ml``.

Parameter translation from the scikit-learn-style signature:
* C (inverse regularisation) -> ``regParam = 1 / (C * n_train)``, no
  feature standardisation inside the solver (the inputs are already scaled).
* trees: depth None -> 30 (Spark's maximum); ``min_samples_leaf`` is
  ``minInstancesPerNode``; ``min_samples_split`` has no Spark twin, so the fitted
  tree's smaller splits are folded into leaves (:func:`trees.fold_splits`), which
  is the same tree.  Without a depth limit :mod:`forest` grows them.
* kernel SVM: Nystroem feature map (landmarks from a key-hash sample,
  bounded) + a linear SVM (``LinearSVC``'s objective); probabilities by Platt scaling (a logistic
  regression on margins of rows that the scored SVM was not fitted on).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LinearSVCModel,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, scratch_path
from . import metrics as V
from .common import held, parallel_map
from .forest import ForestClassifier
from .hinge import TILE, fit_hinge, margins, packed
from .logit import FoldedLogit, Spec
from .split import hash_bucket
from .trees import fold_splits

MODEL_NAMES = ("logistic_regression", "decision_tree", "random_forest", "svm")


def assembler(features: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return assembler(features, out).transform(df)


# M2 ------------------------------------------------------------------------
def logistic_regression(n_train: int, C: float = 1.0, penalty: str = "l2", max_iter: int = 1000,
                        label: str = "label", features: str = "features", tol: float = 1e-6) -> LogisticRegression:
    if penalty not in ("l1", "l2", "none", None):
        raise ValueError(f"unsupported penalty {penalty!r}")
    reg = 0.0 if penalty in ("none", None) else 1.0 / (C * n_train)
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=reg,
                              elasticNetParam=1.0 if penalty == "l1" else 0.0,
                              standardization=False, maxIter=max_iter, tol=tol)


# M3 ------------------------------------------------------------------------
#: Deep trees: rows keep their node instead of passing every tree again.  (More
#: memory for statistics than Spark's 256 MB only costs time to clear it.)
DEEP = {"cacheNodeIds": True, "checkpointInterval": 10}


def decision_tree(max_depth: int | None = None, min_samples_leaf: int = 1, criterion: str = "gini", max_bins: int = 64,
                  seed: int = 42, label: str = "label", features: str = "features") -> DecisionTreeClassifier:
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=min(max_depth or 30, 30),
                                  minInstancesPerNode=int(min_samples_leaf), impurity=criterion, maxBins=max_bins, seed=seed, **DEEP)


# M4 ------------------------------------------------------------------------
def random_forest(n_estimators: int = 100, max_features: str = "sqrt", max_depth: int | None = None, min_samples_leaf: int = 1,
                  criterion: str = "gini", bootstrap: bool = True, seed: int = 42, max_bins: int = 64,
                  label: str = "label", features: str = "features") -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=n_estimators,
                                  featureSubsetStrategy=max_features, maxDepth=min(max_depth or 30, 30),
                                  minInstancesPerNode=int(min_samples_leaf), impurity=criterion, bootstrap=bootstrap,
                                  maxBins=max_bins, seed=seed, **DEEP)


#: Trees of more levels have nodes in proportion to the rows: they are grown by :mod:`forest`.
SHALLOW = 12


def deep_forest(name: str, settings: dict, label: str) -> ForestClassifier | None:
    """The estimator of a tree or forest without a (low) depth limit; None for
    one that Spark's own fits, or whose splits are folded after the fit."""
    if (settings.get("max_depth") or 30) <= SHALLOW or settings.get("min_samples_split", 2) > 2 or settings.get("max_bins", 64) > 256:
        return None
    of = decision_tree if name == "decision_tree" else random_forest
    own = of(label=label, **{k: v for k, v in settings.items() if k != "min_samples_split"})
    one = name == "decision_tree"
    return ForestClassifier(own.getFeaturesCol(), label, 1 if one else own.getNumTrees(), own.getSeed(), own.getMaxDepth(), own.getMaxBins(),
                            "all" if one else own.getFeatureSubsetStrategy(), own.getMinInstancesPerNode(), own.getImpurity(), not one and own.getBootstrap())


# M5 ------------------------------------------------------------------------
#: Norm of a projection up to which kernel values of 24 bits will do for a fit.
MAGNIFIED = 1000.0


class NystroemMap(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """features -> Nystroem kernel features (rbf or poly) via one Arrow UDF, whose values are not taken apart.

    The landmark matrix (m x d) and the m x m projection are parameters, so the
    stage can be saved; both are bounded by ``m`` (not by the data).
    """

    landmarks = Param(Params._dummy(), "landmarks", "landmark rows, flattened", TypeConverters.toListFloat)
    proj = Param(Params._dummy(), "proj", "m x m projection, flattened", TypeConverters.toListFloat)
    kernel = Param(Params._dummy(), "kernel", "rbf or poly", TypeConverters.toString)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    degree = Param(Params._dummy(), "degree", "degree of the poly kernel", TypeConverters.toInt)
    coef0 = Param(Params._dummy(), "coef0", "constant of the poly kernel", TypeConverters.toFloat)
    inputCol = Param(Params._dummy(), "inputCol", "features", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "kernel features", TypeConverters.toString)

    @classmethod
    def of(cls, landmarks: np.ndarray, proj: np.ndarray, kernel: str, gamma: float, degree: int = 3,
           coef0: float = 1.0, inputCol: str = "features", outputCol: str = "kfeatures") -> NystroemMap:
        return cls()._set(landmarks=landmarks.ravel().tolist(), proj=proj.ravel().tolist(), kernel=kernel, gamma=gamma,
                          degree=degree, coef0=coef0, inputCol=inputCol, outputCol=outputCol)

    def parts(self):
        """(rows -> kernel values of the landmarks, projection): the map is the one times the other."""
        get = self.getOrDefault
        flat = np.array(get(self.proj))
        m = int(round(len(flat) ** 0.5))
        P, L = flat.reshape(m, m), np.array(get(self.landmarks)).reshape(m, -1)
        kernel, gamma, degree, coef0 = (get(x) for x in (self.kernel, self.gamma, self.degree, self.coef0))
        return (lambda X: kernel_matrix(X, L, kernel, gamma, degree, coef0)), P

    def rounded(self):
        """The kernel values of :meth:`parts`, in single precision where the projection magnifies their rounding little."""
        get = self.getOrDefault
        kernel_of, P = self.parts()
        if not rounds_well(get(self.kernel), P):
            return kernel_of
        return rbf_values(np.array(get(self.landmarks)).reshape(len(P), -1), get(self.gamma))

    def _transform(self, df: DataFrame) -> DataFrame:
        get = self.getOrDefault
        kernel_of, P = self.parts()
        d = len(get(self.landmarks)) // len(P)

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def kmap(x: pa.Array) -> pa.Array:
            X, out = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), d), np.empty((len(x), len(P)))
            for lo in range(0, len(X), TILE):
                np.dot(kernel_of(X[lo:lo + TILE]), P, out=out[lo:lo + TILE])
            return pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, len(P), dtype=np.int32)), pa.array(out.ravel()))

        return df.withColumn(get(self.outputCol), array_to_vector(kmap(vector_to_array(get(self.inputCol)))))


def kernel_matrix(X: np.ndarray, L: np.ndarray, kernel: str, gamma: float, degree: int = 3,
                  coef0: float = 1.0) -> np.ndarray:
    if kernel == "rbf":
        d2 = (X * X).sum(1)[:, None] - 2 * X @ L.T + (L * L).sum(1)[None, :]
        return np.exp(-gamma * np.maximum(d2, 0.0))
    if kernel == "poly":
        return (gamma * X @ L.T + coef0) ** degree
    raise ValueError(f"unsupported kernel {kernel!r}")


def rounds_well(kernel: str, proj: np.ndarray) -> bool:
    return kernel == "rbf" and np.linalg.norm(proj, 2) <= MAGNIFIED


def rbf_values(L: np.ndarray, gamma: float):
    """rows -> rbf kernel values of the landmarks in single precision; the exponent is one
    product in double precision, (x, 1, |x|^2) with (2 gamma l, -gamma |l|^2, -gamma)."""
    by = np.hstack([2 * gamma * L, -gamma * (L * L).sum(1)[:, None], np.full((len(L), 1), -gamma)]).T

    def values(X):
        e = (np.hstack([X, np.ones((len(X), 1)), (X * X).sum(1)[:, None]]) @ by).astype(np.float32)
        return np.exp(np.minimum(e, 0, out=e), out=e)

    return values


def fit_nystroem(df: DataFrame, key: list[str], kernel: str = "rbf", gamma="scale", degree: int = 3,
                 n_landmarks: int = 300, seed: int = 42, features: str = "features") -> NystroemMap:
    arr = vector_to_array(features)
    # gamma='scale' = 1 / (d * var(X)) over all feature values: one aggregate
    d = len(df.select(features).first()[0])
    if gamma == "scale":
        st = df.select(F.explode(arr).alias("v")).agg(F.var_pop("v").alias("vr")).first()
        gamma = 1.0 / (d * st["vr"]) if st["vr"] else 1.0
    elif gamma == "auto":
        gamma = 1.0 / d
    # landmarks: the m rows with the smallest key hash (top-k, bounded by m)
    lm = (df.select(hash_bucket(key, f"{seed}/nystroem", 1 << 30).alias("_h"), arr.alias("x"))
            .orderBy("_h").limit(n_landmarks).collect())
    L = np.array([r["x"] for r in lm], dtype=float)
    K = kernel_matrix(L, L, kernel, float(gamma), degree)
    w, U = np.linalg.eigh(K)
    w = np.maximum(w, 1e-12)
    proj = U @ np.diag(1.0 / np.sqrt(w)) @ U.T
    return NystroemMap.of(L, proj, kernel, float(gamma), degree, inputCol=features)


def train_svm(df: DataFrame, key: list[str], label: str = "label", kernel: str = "rbf", C: float = 1.0,
              gamma="scale", degree: int = 3, n_landmarks: int = 300, max_iter: int = 200,
              seed: int = 42, features: str = "features", n_train: int | None = None, calibration_folds: int = 5) -> PipelineModel:
    """Kernel map (unless linear) -> linear SVM -> margin -> Platt scaling.

    ``prediction`` is the sign of the SVM margin, ``probability`` the
    Platt-scaled margin.  The scaling is fitted on margins of rows that the SVM
    giving them was not fitted on (``calibration_folds`` SVMs, one for each part
    of the keys), as margins of an SVM's own training rows are too sure.  All
    the SVMs share their passes (:func:`hinge.fit_hinge`).  All stages can be saved."""
    n = n_train or df.count()
    stages, feats, kernel_of, rounded, proj = [], features, _as_is, _as_is, None
    if kernel != "linear":
        stages.append(fit_nystroem(df, key, kernel, gamma, degree, n_landmarks, seed, features))
        feats = "kfeatures"
        kernel_of, proj = stages[0].parts()
        rounded = stages[0].rounded()
    part = (hash_bucket(key, f"{seed}/platt") % calibration_folds).cast("int").alias("fold")
    # the rows' own features are kept, not those of the kernel map
    with held(packed(df.select(part, F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x")))) as rows:
        reg = [1.0 / (C * n), *[1.0 / (C * n * (calibration_folds - 1) / calibration_folds)] * calibration_folds]
        (w, b), *others = fit_hinge(rows, [None, *range(calibration_folds)], rounded, proj, reg, calibration_folds, max_iter)
        told = margins(rows, kernel_of, proj, others).select(F.col("y").alias(label), array_to_vector(F.array("margin")).alias("margin"))
        platt = LogisticRegression(featuresCol="margin", labelCol=label, regParam=0.0, probabilityCol="probability",
                                   predictionCol="platt_prediction", rawPredictionCol="platt_raw").fit(told)
    margin = VectorSlicer(inputCol="rawPrediction", outputCol="margin", indices=[1])
    return PipelineModel(stages=[*stages, _svc_model(df.sparkSession, w, b, feats, label), margin, platt])


def _as_is(x: np.ndarray) -> np.ndarray:
    return x


def _svc_model(spark: SparkSession, w: np.ndarray, b: float, features: str, label: str) -> LinearSVCModel:
    """Spark's model of these coefficients: a saved one whose data are rewritten."""
    zero = DenseVector(np.zeros(len(w)))
    path, new = (scratch_path(spark, f"svm/{uuid.uuid4().hex}") for _ in range(2))
    LinearSVC(featuresCol=features, labelCol=label, maxIter=1).fit(
        spark.createDataFrame([(zero, 0.0), (zero, 1.0)], [features, label])).write().save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    spark.createDataFrame([{"coefficients": DenseVector(w), "intercept": float(b)}], schema).coalesce(1).write.parquet(f"{new}/data")
    spark.read.text(f"{path}/metadata").coalesce(1).write.text(f"{new}/metadata")
    return LinearSVCModel.load(new)


class KernelSVM(Estimator):
    """``train_svm`` as an estimator, so that kernel, C, gamma and degree can be searched.

    Without ``keyCols`` the landmarks are chosen by a hash of the features."""

    kernel = Param(Params._dummy(), "kernel", "linear, rbf or poly", TypeConverters.toString)
    C = Param(Params._dummy(), "C", "inverse regularisation", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "scale, auto or a number", TypeConverters.identity)
    degree = Param(Params._dummy(), "degree", "degree of the poly kernel", TypeConverters.toInt)
    nLandmarks = Param(Params._dummy(), "nLandmarks", "landmarks of the kernel map", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "iterations of the linear SVM", TypeConverters.toInt)
    keyCols = Param(Params._dummy(), "keyCols", "columns that name a row", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)

    def __init__(self, key=(), label: str = "label"):
        super().__init__()
        self._setDefault(kernel="rbf", C=1.0, gamma="scale", degree=3, nLandmarks=300, maxIter=200,
                         keyCols=list(key), labelCol=label)

    def _fit(self, df: DataFrame) -> PipelineModel:
        get = self.getOrDefault
        key, label = get(self.keyCols), get(self.labelCol)
        if not key:
            key, df = ["_features"], df.withColumn("_features", vector_to_array("features").cast("string"))
        return train_svm(df, key, label, get(self.kernel), get(self.C), get(self.gamma), get(self.degree),
                         get(self.nLandmarks), get(self.maxIter))


# M6 ------------------------------------------------------------------------
@dataclass
class Trained:
    name: str
    model: object
    params: dict = field(default_factory=dict)


def fit_model(name: str, train: DataFrame, key: list[str], label: str = "label", n_train: int | None = None,
              **params) -> Trained:
    n = n_train or train.count()
    settings, split = dict(params), params.get("min_samples_split", 2)
    deep = None
    if name in ("decision_tree", "random_forest"):
        deep = deep_forest(name, settings, label)
        settings.pop("min_samples_split", None)
    if deep is not None:
        m = deep.fit(train)
    elif name == "logistic_regression":
        m = logistic_regression(n, label=label, **settings).fit(train)
    elif name == "decision_tree":
        m = fold_splits(decision_tree(label=label, **settings).fit(train), split)
    elif name == "random_forest":
        m = fold_splits(random_forest(label=label, **settings).fit(train), split)
    elif name == "svm":
        m = train_svm(train, key, label=label, n_train=n, **settings)
    else:
        raise ValueError(f"unknown model {name!r}")
    return Trained(name, m, params)


def train_all(train: DataFrame, key: list[str], label: str = "label", names=MODEL_NAMES,
              params: dict | None = None) -> dict[str, Trained]:
    n = train.count()
    params = params or {}
    return {nm: fit_model(nm, train, key, label, n, **params.get(nm, {})) for nm in names}


def predictions(model, df: DataFrame, label: str = "label") -> DataFrame:
    """(y, pred, s) where s = P(class 1)."""
    out = model.transform(df)
    return out.select(F.col(label).cast("int").alias("y"), F.col("prediction").cast("int").alias("pred"),
                      vector_to_array("probability")[1].alias("s"))


# M7 / V9 -------------------------------------------------------------------
def cross_validate(df: DataFrame, name: str, key: list[str], label: str = "label", k: int = 5,
                   seed: int = 42, fold_col: str = "fold", parallelism: int = 4, shared: bool = True, **params) -> DataFrame:
    """k-fold CV: fit on k-1 folds (``parallelism`` fits at a time), predict
    the held-out fold; all fold predictions are unioned and every metric is
    computed per fold in ONE grouped pass.
    Returns (fold, accuracy, precision, recall, f1, roc_auc).

    Ridge-penalised logistic regressions of two classes are fitted by
    :class:`logit.FoldedLogit`, whose folds share their passes, unless every fold
    is to be a fit of :func:`fit_model` (``shared=False``)."""
    if shared and name == "logistic_regression" and set(params) <= {"C"}:
        told = _logit_left_out(df, label, k, fold_col, **params)
        if told is not None:
            return _fold_metrics(told)
    # what fits and predictions read, not the frame's other columns
    df = df.select(*[c for c in df.columns if c in {*key, label, fold_col, "features"}])
    with held(df) as rows:
        sizes = {r[0]: r[1] for r in rows.groupBy(fold_col).count().collect()}   # k rows
        n = sum(sizes.values())

        def fit_fold(f):
            tr = rows.filter(F.col(fold_col) != f)
            return fit_model(name, tr, key, label, n_train=n - sizes.get(f, 0), **params).model

        models = parallel_map(fit_fold, range(k), parallelism)
        # a model's own steps (a forest writes its votes) run side by side, too
        preds = parallel_map(lambda fm: predictions(fm[1], rows.filter(F.col(fold_col) == fm[0]), label).withColumn("fold", F.lit(fm[0])),
                             enumerate(models), parallelism)
        allp = preds[0]
        for p in preds[1:]:
            allp = allp.unionByName(p)
        told = materialize(allp, "fold-scores")
    return _fold_metrics(told)


def _logit_left_out(df: DataFrame, label: str, k: int, fold_col: str, C: float = 1.0) -> DataFrame | None:
    """(fold, y, pred, s) of every row by the model its fold was left out of, written;
    None where the labels of some training rows are not just 0 and 1."""
    y = F.col(label)
    per = df.groupBy(fold_col).agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"), F.count(F.lit(1)).alias("n")).collect()   # k rows
    per = {r[fold_col]: r for r in per}
    first = df.select("features").first()
    if first is None or any(r["n0"] + r["n1"] < r["n"] for r in per.values()):
        return None
    if any(sum(r[c] for f, r in per.items() if f != skip) == 0 for skip in range(k) for c in ("n0", "n1")):
        return None
    models = [Spec(f, tuple(range(len(first[0])))) for f in range(k)]
    with FoldedLogit(df, vector_to_array("features"), label, fold_col, len(first[0])) as data:
        told = data.left_out(models, data.fit(models, C))
        return materialize(told.select("fold", F.col("y").cast("int").alias("y"), (F.col("s") > 0.5).cast("int").alias("pred"), "s"), "fold-scores")


def _fold_metrics(told: DataFrame) -> DataFrame:
    """Metrics per fold from a written table (fold, y, pred, s)."""
    bm = V.binary_metrics(told, "y", "pred", ["fold"])
    au = V.auc_ap(told, "y", "s", ["fold"])
    return bm.join(au, "fold").select("fold", "accuracy", "precision", "recall", "f1", "roc_auc")


def cv_summary(cv: DataFrame, model: str) -> DataFrame:
    """mean and population std per metric across folds."""
    ms = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    aggs = []
    for m in ms:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return cv.agg(*aggs).select(F.lit(model).alias("model"), "*")


# M9 ------------------------------------------------------------------------
def importances(model, names: list[str]) -> list[tuple[str, float]]:
    """Feature importances (trees) or |coefficients| (linear), in feature order."""
    if hasattr(model, "featureImportances"):
        v = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        v = np.abs(model.coefficients.toArray())
    else:
        return []
    return [(n, float(x)) for n, x in zip(names, v)]


def pipeline(features: list[str], estimator) -> Pipeline:
    return Pipeline(stages=[assembler(features), estimator])


"""ML integration on the small tables: invariants, search, registry, streaming."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.operators import classify as M
from tabforge.operators import metrics as V
from tabforge.operators import pca as X
from tabforge.operators import tune as H
from tabforge.operators.registry import ModelRegistry

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def frame(spark):
    from tabforge.plans.q_models import ml_frame
    df, spec = ml_frame(spark, SF_SMALL)
    return df, spec


def test_models_probabilities_and_cv(spark, frame):
    df, spec = frame
    train = df.filter("split = 'train'")
    for name, params in [("logistic_regression", {}), ("decision_tree", {"max_depth": 4}),
                         ("svm", {"kernel": "rbf", "n_landmarks": 30, "max_iter": 20})]:
        m = M.fit_model(name, train, list(spec.key), **params).model
        p = m.transform(df.filter("split = 'test'")).select(vector_to_array("probability").alias("p"))
        bad = p.filter(F.abs(F.aggregate("p", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9).count()
        assert bad == 0
    cv = M.cross_validate(df, "logistic_regression", list(spec.key), k=5).collect()
    assert sorted(r["fold"] for r in cv) == [0, 1, 2, 3, 4]
    assert all(0 <= r["accuracy"] <= 1 for r in cv)


def test_folds_of_a_logistic_regression_share_their_passes(spark, frame, monkeypatch):
    """The figures are those of separate fits of Spark, and no fold is fitted by itself."""
    df, spec = frame
    df = df.withColumn("label", (F.col("l_quantity") + F.rand(5) * 3 > 1).cast("double")).cache()
    one = M.fit_model("logistic_regression", df.filter("fold <> 3"), list(spec.key)).model
    told = M.predictions(one, df.filter("fold = 3"))
    want = V.binary_metrics(told, "y", "pred").first().asDict() | V.auc_ap(told, "y", "s").first().asDict()
    monkeypatch.setattr(M, "fit_model", lambda *a, **k: pytest.fail("a fit of one fold"))
    got = {r["fold"]: r for r in M.cross_validate(df, "logistic_regression", list(spec.key)).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4]
    for m in ("accuracy", "precision", "recall", "f1", "roc_auc"):
        assert got[3][m] == pytest.approx(want[m], abs=2e-3), m
    df.unpersist()


def test_search_isolates_failures(spark, frame):
    df, spec = frame
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    res = H.search_all(train, test, n_iter=2, names=["logistic_regression", "no_such_model"])
    rep = {r["model"]: r for r in H.report(spark, res).collect()}
    assert rep["logistic_regression"]["error"] is None and rep["logistic_regression"]["n_candidates"] == 2
    assert rep["no_such_model"]["error"] is not None


def test_registry_roundtrip(spark, frame, tmp_path):
    from pyspark.ml import Pipeline
    df, spec = frame
    train = df.filter("split = 'train'").drop("features")
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    pm = Pipeline(stages=[M.assembler(feats), M.logistic_regression(train.count())]).fit(train)
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    v1 = reg.save("lr", pm, {"accuracy": 0.5})
    v2 = reg.save("lr", pm, {"accuracy": 0.6})
    assert reg.latest("lr") == v2 > v1
    checks = {r["check"]: r["ok"] for r in reg.validate("lr", v2, test=train, probe=train).collect()}
    assert checks == {"stages": True, "sha256": True, "predict": True, "accuracy": True}
    assert reg.promote_best("accuracy")["version"] == v2
    assert reg.production()["version"] == v2
    assert len(reg.load("lr").stages) == 2
    with pytest.raises(FileNotFoundError):
        reg.load("nope")


def test_pca_invariants(spark):
    from tabforge.sources.tables import vectors
    df, spec = vectors(spark, SF_SMALL)
    r = X.fit_pca(df, list(spec.numeric)[:16])
    assert abs(r.ratio.sum() - 1) < 1e-9 and all(r.ratio[i] >= r.ratio[i + 1] - 1e-12 for i in range(15))
    for j in range(r.components.shape[1]):
        col = r.components[:, j]
        assert col[abs(col).argmax()] > 0          # canonical sign
    assert r.n_for(2.0) is None                      # never reached -> NULL (not 1)


def test_stream_scores_every_row(spark):
    from __spark_entry__ import queries
    out = queries()["stream_score"](spark, SF_SMALL)
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert out.count() == n
    # a row has either a score or the error that kept it from being scored
    assert out.filter(F.col("confidence").isNull() != F.col("error").isNotNull()).count() == 0
    assert 0 < out.filter(F.col("error").isNull()).count() < n


def test_stream_reads_a_folder_of_files(spark, tmp_path):
    from __spark_entry__ import queries
    for name, parts in (("lineitem", 3), ("orders", 2)):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").repartition(parts).write.parquet(f"{tmp_path}/{name}.parquet")
    out = queries()["stream_score"](spark, str(tmp_path))
    assert out.count() == spark.read.parquet(f"{tmp_path}/lineitem.parquet").count()


def test_invalid_requests_are_not_scored(spark):
    from tabforge.functions import rules as RL
    from tabforge.streaming.scoring import scoring_frame

    class Model:
        def transform(self, df):
            from pyspark.ml.functions import array_to_vector
            return df.withColumn("prediction", F.lit(1.0)).withColumn("probability", array_to_vector(F.array(F.lit(0.2), F.lit(0.8))))

    rules = RL.RuleSet(risk=(), protective=())
    df = spark.createDataFrame([(50.0,), (-5.0,)], "l_quantity double")
    got = {r["l_quantity"]: r for r in scoring_frame(df, Model(), rules, {"l_quantity": ("range", 1, 50)}, {}).collect()}
    assert got[50.0]["prediction"] == 1 and got[50.0]["error"] is None
    assert got[-5.0]["prediction"] is None and got[-5.0]["confidence"] is None and got[-5.0]["error"]


def test_helpers_p1_p2_f14_h5_h6(spark, frame, tmp_path):
    from tabforge.operators import clean as C
    from tabforge.operators import select as SEL
    from tabforge.spec import FeatureSpec
    df, spec = frame
    x, y = C.split_xy(df, spec)
    assert spec.target not in x.columns and y.columns == list(spec.key) + [spec.target]
    with pytest.raises(ValueError):
        C.split_xy(df.drop(spec.target), spec)
    rp = C.role_pipeline(FeatureSpec(numeric=("l_quantity", "l_tax"), categorical=("l_linenumber",)))
    out = rp.fit(df.drop("features")).transform(df.drop("features"))
    assert len(out.select("features").first()[0]) == 3
    feats, perf = SEL.select_features(df, ["l_quantity", "l_discount"], ["l_linenumber"], "label",
                                      strategy="union", k=2)
    assert feats and 0 <= perf["cv_mean"] <= 1
    with pytest.raises(ValueError):
        SEL.select_features(df, ["l_quantity"], [], "label", strategy="nope")
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    res = H.search_all(train, test, n_iter=2, names=["decision_tree"])
    accs = H.cv_tuned(train, "decision_tree", H.estimators(100)["decision_tree"], res[0]["best_params"])
    assert len(accs) == 5 and all(0 <= a <= 1 for a in accs)
    reg = ModelRegistry(spark, str(tmp_path / "reg2"))
    saved = H.save_best(reg, res, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                                   "l_linestatus", "l_linenumber"])
    assert set(saved) == {"decision_tree"}
    assert reg.load("decision_tree").transform(test.drop("features")).count() == test.count()


def test_svm_keeps_no_kernel_features(spark, monkeypatch):
    """What is kept while an SVM is fitted is as wide as its input; the coefficients minimise LinearSVC's objective."""
    import numpy as np
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.functions import vector_to_array

    r = np.random.default_rng(6)
    x = r.normal(size=(500, 3)) * [1.0, 3.0, 0.2] + [0.0, 5.0, 1.0]
    y = (x[:, 0] ** 2 + x[:, 1] / 4 + r.normal(size=500) > 2.2).astype(float)
    df = M.assemble(spark.createDataFrame([(i, float(t), *map(float, v)) for i, (t, v) in enumerate(zip(y, x))], ["id", "label", "a", "b", "c"]).repartition(3, "id"), ["a", "b", "c"])
    kept, whole = [], M.held
    monkeypatch.setattr(M, "held", lambda rows: (kept.append(rows.first()), whole(rows))[1])
    model = M.train_svm(df, ["id"], n_landmarks=20, C=0.5, max_iter=60)
    assert kept and max(len(v) for row in kept for v in row if hasattr(v, "__len__")) == 3
    for kernel, fitted in (("rbf", model), ("linear", M.train_svm(df, ["id"], kernel="linear", C=0.5, max_iter=60))):
        mapped, svc = fitted.stages[0].transform(df) if kernel == "rbf" else df, fitted.stages[-3]
        own = LinearSVC(featuresCol=svc.getFeaturesCol(), labelCol="label", regParam=1.0 / (0.5 * 500), maxIter=60).fit(mapped)
        z = np.array([v["z"] for v in mapped.select(vector_to_array(svc.getFeaturesCol()).alias("z"), "id").orderBy("id").collect()])

        def objective(m):
            w = m.coefficients.toArray()
            return np.maximum(0, 1 - (2 * y - 1) * (z @ w + m.intercept)).mean() + 0.5 / 250 * ((w * z.std(0, ddof=1)) ** 2).sum()

        assert objective(svc) <= objective(own) * 1.01
    assert fitted.transform(df).select("prediction", "probability").count() == 500


def test_kernel_map_takes_rows_in_tiles(spark, monkeypatch):
    """The mapped features of a batch are written as one array; no more rows than a tile meet the landmarks at once."""
    import numpy as np

    r = np.random.default_rng(3)
    L, P, x = r.normal(size=(9, 2)), r.normal(size=(9, 9)), r.normal(size=(700, 2))
    kmap = M.NystroemMap.of(L, P, "rbf", 0.5)
    df = M.assemble(spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double").coalesce(1), ["a", "b"])
    most = spark.sparkContext.accumulator(0)

    def values(X):
        most.add(int(len(X) > 256))
        return M.kernel_matrix(X, L, "rbf", 0.5)

    monkeypatch.setattr(kmap, "parts", lambda: (values, P), raising=False)
    got = np.array([v["kfeatures"].toArray() for v in kmap.transform(df).orderBy("id").collect()])
    assert np.allclose(got, M.kernel_matrix(x, L, "rbf", 0.5) @ P) and most.value == 0
    assert kmap.transform(df.limit(0)).collect() == []

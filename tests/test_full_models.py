"""Registered model queries and searches run the whole models and grids."""

import os
import random
from types import SimpleNamespace

import pytest

from tabforge.operators import classify as M
from tabforge.operators import select as SEL

from .conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


@pytest.fixture(scope="module")
def frame(spark):
    from tabforge.plans.q_models import OL_FEATS
    r = random.Random(3)
    rows = [(i, i % 5, "test" if i % 4 == 0 else "train", float(i // 5 % 2), *[r.gauss(i // 5 % 2, 1.0) for _ in OL_FEATS])
            for i in range(200)]
    df = spark.createDataFrame(rows, ["id", "fold", "split", "label", *OL_FEATS]).coalesce(1)
    return M.assemble(df, OL_FEATS).cache(), SimpleNamespace(key=("id",), target="label")


@pytest.mark.parametrize("name", ["rforest", "impact", "cv_models", "model_summary"])
def test_queries_fit_default_models(spark, frame, monkeypatch, name):
    from __spark_entry__ import queries
    from tabforge.plans import q_models
    monkeypatch.setattr(q_models, "ml_frame", lambda *a: frame)
    fits = []

    def fit(model, train, key, label="label", n_train=None, **params):
        fits.append((model, params))
        return M.Trained(model, M.logistic_regression(1000, max_iter=1).fit(train), params)

    monkeypatch.setattr(M, "fit_model", fit)
    queries()[name](spark, SF_SMALL)
    assert {m for m, _ in fits} == ({"random_forest"} if name in ("rforest", "impact") else set(M.MODEL_NAMES))
    assert all(params == {} for _, params in fits)


def test_default_models_are_full(spark):
    rf = M.random_forest()
    assert rf.getNumTrees() == 100 and rf.getMaxDepth() == 30
    assert M.decision_tree().getMaxDepth() == 30


def forest_only(*a, **kw):
    raise ValueError("only the forest is looked at")


@pytest.mark.parametrize("name", ["rf_importance", "compare_selectors"])
def test_importance_forests_have_no_depth_limit(spark, frame, monkeypatch, name):
    from __spark_entry__ import queries
    from tabforge.plans import q_models
    monkeypatch.setattr(q_models, "ml_frame", lambda *a: frame)
    sizes = []

    def forest(**kw):
        sizes.append((kw["numTrees"], kw["maxDepth"]))
        raise ValueError("no fit here")

    monkeypatch.setattr(SEL, "RandomForestClassifier", forest)
    for other in ("rfe", "anova_f", "chi2_scores", "mutual_info_knn", "corr_filter"):
        monkeypatch.setattr(SEL, other, forest_only)
    monkeypatch.setattr(SEL, "best_method", lambda comp: "none")
    try:
        queries()[name](spark, SF_SMALL)
    except ValueError:
        pass
    assert sizes == [(100, 30)]


def test_grids_hold_every_value_of_the_reference(spark):
    from tabforge.operators import tune as H
    full, drawn = ({name: H.combinations(v) for name, v in g.items()} for g in (H.FULL, H.DRAWN))
    assert {k: len(v) for k, v in full.items()} == {"logistic_regression": 72, "decision_tree": 672, "random_forest": 1080, "svm": 216}
    assert {k: len(v) for k, v in drawn.items()} == {"logistic_regression": 36, "decision_tree": 192, "random_forest": 360, "svm": 48}
    assert {c["n_estimators"] for c in full["random_forest"]} == {50, 100, 200, 300, 500}
    assert None in {c["max_depth"] for c in full["random_forest"]}
    svm = H.estimators(100)["svm"]
    maps = [H.param_map(svm, c, 100) for c in full["svm"]]
    assert {m[svm.kernel] for m in maps} == {"linear", "rbf", "poly"}
    assert {m.get(svm.gamma) for m in maps} == {None, "scale", "auto", 0.001, 0.01, 0.1, 1.0}


def test_searches_cover_all_models(spark, frame, monkeypatch):
    from __spark_entry__ import queries
    from tabforge.operators import tune as H
    from tabforge.plans import q_models
    monkeypatch.setattr(q_models, "ml_frame", lambda *a: frame)
    asked = []

    def search(train, test, name, est, combos, n_iter=None, **kw):
        asked.append((name, len(combos), n_iter))
        raise ValueError("not fitted here")

    monkeypatch.setattr(H, "search", search)
    queries()["random_search"](spark, SF_SMALL)
    assert asked == [("logistic_regression", 36, 50), ("decision_tree", 192, 50), ("random_forest", 360, 50), ("svm", 48, 50)]
    asked.clear()
    queries()["grid_search"](spark, SF_SMALL)
    assert asked == [("logistic_regression", 72, None), ("decision_tree", 672, None), ("random_forest", 1080, None), ("svm", 216, None)]


def test_failures_of_spark_are_not_rows(spark, frame, monkeypatch):
    from tabforge.operators import tune as H

    def lost(*a, **kw):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(H, "search", lost)
    with pytest.raises(RuntimeError):
        H.search_all(frame[0], frame[0], names=["svm"])
    monkeypatch.setattr(SEL, "anova_f", lost)
    with pytest.raises(RuntimeError):
        SEL.compare_selectors(frame[0], ["l_quantity"], [], "label")


def test_kernel_svm_is_searched(spark, frame):
    from tabforge.operators import tune as H
    df = frame[0]
    est = H.estimators(300)["svm"]
    assert est.getOrDefault(est.kernel) == "rbf" and est.getOrDefault(est.nLandmarks) == 300
    est = est.copy({est.nLandmarks: 10, est.maxIter: 2})
    grid = [{est.kernel: "poly", est.degree: 2, est.C: 1.0, est.gamma: "auto"}, {est.kernel: "rbf", est.gamma: 0.1, est.C: 10.0}]
    maps = [m.stages[0] for m in est.fit(df, grid)]
    assert [(m.getOrDefault(m.kernel), m.getOrDefault(m.degree)) for m in maps] == [("poly", 2), ("rbf", 3)]
    assert maps[0].getOrDefault(maps[0].gamma) == 1 / 7 and maps[1].getOrDefault(maps[1].gamma) == 0.1

"""Golden values published with the clinical data set, reproduced from the
data files they were computed from (paths given by the TABFORGE_* variables
described in conftest.py; skipped when absent)."""

import pytest
from pyspark.sql import functions as F

from tabforge.operators import classify as M
from tabforge.operators import clean as C
from tabforge.operators import cluster as K
from tabforge.operators import metrics as V
from tabforge.operators import pca as X
from tabforge.operators import select as SEL
from tabforge.operators import stats as ST
from tabforge.operators.aggregate import risk_by_band
from tabforge.sources import files as IO
from tabforge.spec import HEART, HEART_COLUMNS

from .conftest import golden, needs

pytestmark = needs("RAW_CSV")
FEATS = list(HEART_COLUMNS[:-1])
# 0-based positions of the recovered hold-out rows (FIXTURES.md 2a).
HOLDOUT = [3, 6, 21, 23, 33, 34, 62, 64, 66, 67, 76, 87, 89, 92, 94, 100, 101, 104, 113, 115, 131, 134, 137,
           155, 157, 160, 162, 166, 168, 172, 179, 185, 186, 187, 196, 197, 205, 212, 213, 219, 231, 233, 234,
           235, 243, 244, 264, 269, 270, 271, 277, 282, 284, 285, 286, 287, 291, 292, 296, 300, 302]
ENSEMBLE = ["cp", "exang", "oldpeak", "slope", "ca", "thal", "sex", "thalach"]


@pytest.fixture(scope="module")
def cleaned(spark):
    raw = IO.load_spec_csv(spark, golden("RAW_CSV"), HEART, list(HEART_COLUMNS))
    cl = C.clean(C.coerce_numeric(raw, HEART), HEART)
    enc, _ = C.encode(cl, HEART)
    out = C.cap_iqr(enc, HEART)
    return out.withColumn("rid", F.monotonically_increasing_id()).cache()


@needs("CLEANED_CSV")
def test_cleaning_matches_published_table(spark, cleaned):
    ref = spark.read.option("header", True).csv(golden("CLEANED_CSV"))
    a = cleaned.select([F.col(c).cast("double").alias(c) for c in HEART_COLUMNS])
    b = ref.select([F.col(c).cast("double").alias(c) for c in HEART_COLUMNS])
    assert a.count() == 303
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_anova_and_chi2(spark, cleaned):
    f = {r["feature"]: r for r in ST.anova_f(cleaned, FEATS, "target", k=8, p_values=True).collect()}
    assert f["thal"]["score"] == pytest.approx(112.7701632779494, rel=1e-12)
    assert f["ca"]["score"] == pytest.approx(80.8006099438765, rel=1e-12)
    assert f["exang"]["score"] == pytest.approx(69.0208907928023, rel=1e-12)
    assert f["thal"]["p_value"] == pytest.approx(1.3894261335845185e-22, rel=1e-10)
    assert f["thal"]["rank"] == 1
    c = {r["feature"]: r for r in ST.chi2_scores(cleaned, FEATS, "target", k=8, p_values=True).collect()}
    assert c["thal"]["score"] == pytest.approx(28.875535822132363, rel=1e-10)
    assert c["ca"]["score"] == pytest.approx(22.42193218237746, rel=1e-10)
    assert c["thal"]["p_value"] == pytest.approx(7.71816089582253e-08, rel=1e-10)


def test_correlation(spark, cleaned):
    r = {(x["a"], x["b"]): x["r"] for x in ST.corr_matrix(cleaned, FEATS).collect()}
    assert abs(r[("oldpeak", "slope")]) == pytest.approx(0.5738529435676675, rel=1e-12)


def test_pca(spark, cleaned):
    r = X.fit_pca(cleaned, FEATS)
    assert list(r.ratio[:3]) == pytest.approx([0.2373545, 0.1229066, 0.0952075], abs=1e-7)
    assert [r.n_for(t) for t in X.THRESHOLDS] == [8, 9, 10, 12, 13]
    assert r.variance[0] == pytest.approx(3.0958, abs=1e-4)
    assert r.singular_values[0] == pytest.approx(30.5768, abs=1e-4)
    pc1 = dict(zip(FEATS, r.components[:, 0]))
    assert abs(pc1["oldpeak"]) == pytest.approx(0.3978, abs=1e-4)
    assert abs(pc1["thalach"]) == pytest.approx(0.3921, abs=1e-4)
    assert abs(pc1["slope"]) == pytest.approx(0.3519, abs=1e-4)


def test_logistic_train_accuracy(spark, cleaned):
    data = M.assemble(cleaned, ENSEMBLE).withColumn("label", F.col("target").cast("double"))
    m = M.logistic_regression(303).fit(data)
    acc = m.transform(data).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc == pytest.approx(0.8481848184818482, abs=1e-9)


@pytest.mark.parametrize("features,cm,auc", [
    (FEATS, (27, 6, 2, 26), 0.946969696969697),
    (ENSEMBLE, (27, 6, 3, 25), 0.9350649350649352),
])
def test_holdout_logistic(spark, cleaned, features, cm, auc):
    rows = cleaned.orderBy("rid").collect()
    keyed = spark.createDataFrame([(i,) + tuple(float(r[c]) for c in HEART_COLUMNS) for i, r in enumerate(rows)],
                                  "pos int, " + ", ".join(f"{c} double" for c in HEART_COLUMNS))
    keyed = keyed.withColumn("split", F.when(F.col("pos").isin(HOLDOUT), "test").otherwise("train"))
    train = keyed.filter("split = 'train'")
    st = C.fit_scaler(train, features)
    sc = M.assemble(C.scale(keyed, features, st), features).withColumn("label", F.col("target"))
    m = M.logistic_regression(242).fit(sc.filter("split = 'train'"))
    p = M.predictions(m, sc.filter("split = 'test'"))
    r = V.confusion(p, "y", "pred").first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == cm
    assert V.auc_ap(p, "y", "s").first()["roc_auc"] == pytest.approx(auc, abs=1e-12)


@needs("ASSIGNMENTS_CSV")
def test_ari_from_published_assignments(spark):
    df = spark.read.option("header", True).option("inferSchema", True).csv(golden("ASSIGNMENTS_CSV"))
    assert K.ari(df, "kmeans_cluster", "true_label").first()[0] == pytest.approx(0.07246874193453086, abs=1e-12)
    assert K.ari(df, "hierarchical_cluster", "true_label").first()[0] == pytest.approx(0.09329122318060278,
                                                                                      abs=1e-12)


def test_age_band_risk(spark, cleaned):
    t = risk_by_band(cleaned, "age", [0, 40, 50, 60, 70, 100], ["<40", "40-49", "50-59", "60-69", "70+"], "target")
    got = {r["band"]: (r["total"], r["positives"]) for r in t.collect()}
    assert got == {"<40": (15, 4), "40-49": (72, 22), "50-59": (125, 60), "60-69": (81, 49), "70+": (10, 4)}


def test_rfe_elimination_order(spark, cleaned):
    data = cleaned.withColumn("label", F.col("target").cast("double"))
    t, _ = SEL.rfe(data, FEATS, "label", n_select=9)
    rank = {r["feature"]: r["ranking"] for r in t.collect()}
    assert sorted(f for f, k in rank.items() if k == 1) == sorted(
        ["sex", "cp", "fbs", "restecg", "exang", "oldpeak", "slope", "ca", "thal"])
    assert [f for f, _ in sorted(((f, k) for f, k in rank.items() if k > 1), key=lambda x: -x[1])] == \
        ["chol", "age", "thalach", "trestbps"]


def test_metric_formulas_forest_counts(spark):
    df = spark.createDataFrame([(27, 6, 2, 26)], "tn long, fp long, fn long, tp long")
    r = V.with_binary_metrics(df).first()
    assert r["accuracy"] == pytest.approx(0.86885, abs=1e-5)
    assert r["precision"] == pytest.approx(0.8125, abs=1e-5)
    assert r["recall"] == pytest.approx(0.92857, abs=1e-5)
    assert r["f1"] == pytest.approx(0.86667, abs=1e-5)

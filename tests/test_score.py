"""Interpretation rules, request validation and scalar functions on the clinical preset."""

import json
import math

import pytest
from pyspark.sql import functions as F

from tabforge.functions import exprs as E
from tabforge.functions import rules as RL
from tabforge.operators import score as Z

from .conftest import golden, needs

INPUTS = ("age", "sex", "cp", "trestbps", "chol", "fbs", "restecg", "thalach", "exang", "oldpeak")
SCHEMA = ", ".join(f"{c} double" for c in INPUTS)


def factors_of(spark, rows, groups):
    df = spark.createDataFrame(rows, SCHEMA)
    return [r[0] for r in df.select(RL.factors(groups)).collect()]


def test_risk_factors_all_and_defaults(spark):
    high = (70.0, 1.0, 1.0, 150.0, 250.0, 1.0, 1.0, 100.0, 1.0, 3.0)
    only_age_sex = (45.0, 1.0) + (None,) * 8
    got = factors_of(spark, [high, only_age_sex], RL.HEART_RULES.risk)
    assert got[0] == ["Advanced age (>65 years)", "Male gender (higher baseline risk)",
                      "High blood pressure (>140 mmHg)", "High cholesterol (>240 mg/dl)", "Chest pain symptoms",
                      "Reduced exercise capacity", "Exercise-induced chest pain", "Significant ST depression",
                      "Elevated fasting blood sugar"]
    assert got[1] == ["Male gender (higher baseline risk)"]
    prot = factors_of(spark, [only_age_sex], RL.HEART_RULES.protective)[0]
    assert prot == ["Excellent exercise capacity", "Optimal blood pressure", "No exercise-induced chest pain",
                    "Normal resting ECG"]


def test_request_validation_messages(spark):
    reqs = [{"age": "150"}, {"foo": "1", "age": "50"}, {"thal": "4"}, {"age": "abc"}, {"age": "50", "thal": "3"},
            {"oldpeak": "7"}]
    df = spark.createDataFrame([(json.dumps(r),) for r in reqs], "j string") \
        .select(F.from_json("j", "map<string,string>").alias("req"))
    out = [r["error"] for r in Z.validate_requests(df, "req", RL.HEART_REQUEST_RULES, RL.HEART_LABELS).collect()]
    assert out == ["Age must be between 20 and 100", "Unknown feature: foo", "Invalid value for Thalassemia",
                   "Age must be a number", None, "ST Depression must be between 0.0 and 6.0"]


def test_align_defaults(spark):
    df = spark.createDataFrame([('{"age": "63", "sex": "1"}',), ('{"age": "x"}',)], "j string") \
        .select(F.from_json("j", "map<string,string>").alias("req"))
    feats = ["age", "sex", "chol"]
    rows = df.select(*Z.align_features(F.col("req"), feats, feats), Z.n_defaulted(F.col("req"), feats)).collect()
    assert tuple(rows[0]) == (63.0, 1.0, 0.0, 1)
    assert rows[1]["age"] is None and rows[1]["n_defaulted"] == 2


def test_confidence_bands_and_category(spark):
    df = spark.createDataFrame([(0.95, 1), (0.85, 0), (0.75, 1), (0.65, 0), (0.5, 7)], "c double, p int")
    rows = df.select(Z.confidence_band(F.col("c")).alias("b"), Z.risk_category(F.col("p")).alias("k"),
                     Z.risk_description(F.col("p"), F.col("c"), RL.HEART_RULES).alias("d")).collect()
    assert [r["b"] for r in rows] == ["Very High", "High", "Moderate", "Low", "Very Low"]
    assert [r["k"] for r in rows] == ["High Risk", "Low Risk", "High Risk", "Low Risk", "Low Risk"]
    assert rows[4]["d"].endswith("additional medical evaluation is recommended.")


def test_normal_percentile_and_scalars(spark):
    df = spark.createDataFrame([(x,) for x in (-3.0, -1.0, 0.0, 0.5, 2.5)], "x double")
    got = [r[0] for r in df.select(E.normal_percentile(F.col("x"), F.lit(0.0), F.lit(1.0))).collect()]
    for x, g in zip((-3.0, -1.0, 0.0, 0.5, 2.5), got):
        assert g == pytest.approx(50 * (1 + math.erf(x / math.sqrt(2))), abs=2e-5)
    steps = [r[0] for r in df.select(E.step_percentile(F.col("x"), F.lit(0.0), F.lit(1.0))).collect()]
    assert steps == [2.5, 16.0, 50.0, 84.0, 99.0]
    s = spark.createDataFrame([("logistic_regression", 10.0, 0.0, "abcdefghij")], "n string, a double, b double, t string")
    r = s.select(E.title_name("n"), E.safe_divide("a", "b", -1.0), E.format_percentage(F.lit(0.8525), 2),
                 E.truncate_string("t", 8)).first()
    assert tuple(r) == ("Logistic Regression", -1.0, "85.25%", "abcde...")


@needs("HISTORY_JSON")
def test_history_records_validate(spark):
    """Every stored request of the published history passes the request rules."""
    recs = json.load(open(golden("HISTORY_JSON")))
    df = spark.createDataFrame([(json.dumps({k: str(v) for k, v in r["input_data"].items()}),) for r in recs],
                               "j string").select(F.from_json("j", "map<string,string>").alias("req"))
    errs = [r["error"] for r in Z.validate_requests(df, "req", RL.HEART_REQUEST_RULES, RL.HEART_LABELS).collect()]
    assert len(errs) == len(recs)
    n_def = [r[0] for r in df.select(Z.n_defaulted(F.col("req"), list(RL.HEART_REQUEST_RULES))).collect()]
    assert n_def[0] == 11          # the first record carries only age and sex


def test_history_append_and_view(spark, tmp_path):
    df = spark.createDataFrame([(60.0, 1.0, 1, 0.91), (40.0, 0.0, 0, 0.55)], "age double, sex double, prediction int, confidence double")
    p = str(tmp_path / "hist")
    Z.append_history(df, p, ["age", "sex"])
    Z.append_history(df.limit(1), p, ["age", "sex"])
    v = Z.history_view(spark, p, n=10).collect()
    assert len(v) == 3 and {r["result"] for r in v} == {"High Risk", "Low Risk"}
    assert {r["confidence"] for r in v} == {"91.0%", "55.0%"}

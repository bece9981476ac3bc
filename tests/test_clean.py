"""Cleaning, validation and IO on the reference's small fixtures (FIXTURES.md section 2)."""

import pytest
from pyspark.sql import functions as F

from tabforge.operators import clean as C
from tabforge.operators import profile as D
from tabforge.sources import files as IO
from tabforge.spec import HEART, HEART_COLUMNS, FeatureSpec

SAMPLE = [
    (63, 1, 1, 145, 233, 1, 2, 150, 0, 2.3, 3, 0, 6, 0),
    (67, 1, 4, 160, 286, 0, 2, 108, 1, 1.5, 2, 3, 3, 2),
    (67, 1, 4, 120, 229, 0, 2, 129, 1, 2.6, 2, 2, 7, 1),
    (37, 1, 3, 130, 250, 0, 0, 187, 0, 3.5, 3, 0, 3, 0),
    (41, 0, 2, 130, 204, 0, 2, 172, 0, 1.4, 1, 0, 3, 0),
]
SCHEMA = ", ".join(f"{c} double" for c in HEART_COLUMNS[:-1]) + ", target int"


def sample_df(spark, rows=SAMPLE):
    return spark.createDataFrame([tuple(None if v is None else float(v) for v in r[:-1]) + (r[-1],)
                                  for r in rows], SCHEMA)


def raw_df(spark, rows):
    """All-string frame, as a CSV with '?' tokens loads."""
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows],
                                 ", ".join(f"{c} string" for c in HEART_COLUMNS))


def test_clean_with_missing_and_tokens(spark):
    rows = [list(r) for r in SAMPLE]
    rows[2][0] = None      # age NaN
    rows[3][3] = None      # trestbps NaN
    rows[2][2] = "?"       # cp '?'
    rows[4][11] = "?"      # ca '?'
    df = raw_df(spark, rows)
    out = C.clean(C.coerce_numeric(df, HEART), HEART)
    nulls = out.select([F.count_if(F.col(c).isNull()).alias(c) for c in out.columns]).first()
    assert sum(nulls) == 0
    got = {r["target"] for r in out.collect()}
    assert got <= {0, 1}
    # medians / modes of the observed values; rows found by their cholesterol value, which nothing changes
    by_chol = {x["chol"]: x for x in out.collect()}
    r = [by_chol[float(x[4])] for x in SAMPLE]
    assert r[2]["age"] == (41.0 + 63.0) / 2
    assert r[3]["trestbps"] == 145.0 - 7.5          # median of 120, 130, 145, 160
    assert r[2]["cp"] == 1.0                          # all tie -> smallest
    assert r[4]["ca"] == 0.0


def test_outlier_capping_fixture(spark):
    df = spark.createDataFrame([(30.0, 120.0, 0), (35.0, 130.0, 1), (40.0, 140.0, 0), (45.0, 150.0, 1),
                                (200.0, 300.0, 0)], "age double, trestbps double, target int")
    spec = HEART.with_(numeric=("age", "trestbps"), categorical=())
    b = C.fit_iqr_bounds(df, ["age", "trestbps"])
    assert b["age"][1] == pytest.approx(60.0) and b["trestbps"][1] == pytest.approx(180.0)
    out = C.cap_iqr(df, spec, b)
    mx = out.agg(F.max("age"), F.max("trestbps")).first()
    assert mx[0] < 200 and mx[1] < 300
    assert [r["target"] for r in out.collect()] == [0, 1, 0, 1, 0]
    rep = {r["column"]: r["outliers"] for r in C.outlier_report(df, b).collect()}
    assert rep == {"age": 1, "trestbps": 1}


def test_validation_missing_range_duplicates(spark):
    rows = [list(r) for r in SAMPLE]
    rows[0][0] = 150.0     # age out of range
    rows[1][1] = 5.0       # sex out of range
    df = sample_df(spark, [tuple(r) for r in rows])
    rep = {(r["check"], r["column"]): r["value"] for r in D.validation_report(df, HEART).collect()}
    assert rep[("range", "age")] == 1 and rep[("range", "sex")] == 1
    assert rep[("is_valid", None)] == 0
    dup = sample_df(spark, SAMPLE + [SAMPLE[0]])
    rep2 = {(r["check"], r["column"]): r["value"] for r in D.validation_report(dup, HEART).collect()}
    assert rep2[("duplicates", None)] == 1
    assert rep2[("is_valid", None)] == 1          # duplicates do not clear validity
    miss = [list(r) for r in SAMPLE]
    miss[0][0] = None
    miss[1][4] = None
    m = {r["column"]: r["missing"] for r in D.missing_counts(sample_df(spark, [tuple(r) for r in miss])).collect()}
    assert m["age"] == 1 and m["chol"] == 1 and m["sex"] == 0


def test_range_sample_is_first_by_key(spark):
    spec = HEART.with_(key=("id",), ranges={"age": (0, 120)})
    df = spark.range(50).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.col("id") + 200.0)
                                .otherwise(F.lit(50.0)).alias("age")).repartition(7)
    r = D.range_violations(df, spec, sample=10).first()
    assert r["violations"] == 25
    assert r["sample"] == ",".join(f"{v:.2f}" for v in [200.0 + 2 * i for i in range(10)])


def test_csv_header_check(spark, tmp_path):
    p = tmp_path / "h.csv"
    p.write_text(",".join(HEART_COLUMNS) + "\n" + "\n".join(",".join(str(v) for v in r) for r in SAMPLE) + "\n")
    df = IO.load_csv_checked(spark, str(p), list(HEART_COLUMNS), target="target")
    assert df.count() == 5 and dict(df.dtypes)["target"] == "int"
    bad = tmp_path / "bad.csv"
    bad.write_text(",".join(f"x{i}" for i in range(14)) + "\n1" + ",1" * 13 + "\n")
    with pytest.raises(ValueError, match="Column mismatch"):
        IO.load_csv_checked(spark, str(bad), list(HEART_COLUMNS))
    with pytest.raises(FileNotFoundError):
        IO.load_csv_checked(spark, str(tmp_path / "nope.csv"), list(HEART_COLUMNS))


def test_scaling(spark):
    df = sample_df(spark)
    st = C.fit_scaler(df, ["age", "chol"])
    z = C.scale(df, ["age", "chol"], st).agg(F.avg("age"), F.stddev_pop("age")).first()
    assert z[0] == pytest.approx(0.0, abs=1e-12) and z[1] == pytest.approx(1.0)
    const = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    mm = C.scale(const, ["x"], C.fit_scaler(const, ["x"]), "minmax").collect()
    assert [r["x"] for r in mm] == [0.0, 0.0]
    with pytest.raises(ValueError):
        C.scale(df, ["age"], st, "robust")


def test_clean_with_levels_equals_two_pass(spark):
    rows = [list(r) for r in SAMPLE]
    rows[2][2] = "?"
    rows[4][11] = "?"
    rows[1][13] = None      # NULL target row is dropped; its levels must not appear
    rows[1][12] = "9"
    df = raw_df(spark, rows)
    one, lv = C.clean_with_levels(df, HEART)
    two = C.clean(df, HEART)
    info = C.fit_encoding(two, HEART)
    assert {c: v[1] for c, v in lv.items()} == {c: v[1] for c, v in info.items()}
    a = C.encode(one, HEART, lv)[0]
    b = C.encode(two, HEART, info)[0]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_encode_string_categories(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "g string")
    out, info = C.encode(df, FeatureSpec(categorical=("g",)))
    assert info["g"][1] == ["a", "b", "c"]
    assert [r["g"] for r in out.collect()] == [1, 0, 2, 0]


def test_many_levels_are_ranked_by_a_table(spark, monkeypatch):
    """Beyond the literal limit the levels stay a table; the codes are the same."""
    rows = [(i, f"v{i * 37 % 211:03d}", i % 2, None if i % 11 == 0 else "ab"[i % 2]) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, many string, few int, two string").repartition(4)
    spec = FeatureSpec(key=("id",), categorical=("many", "few", "two"))
    want, info = C.encode(df, spec)
    assert len(info["many"][1]) == 211
    monkeypatch.setattr(C, "MAX_LITERAL_LEVELS", 2)
    got, info = C.encode(df, spec)
    assert isinstance(info["many"][1], C.LevelTable) and info["many"][1].n == 211 and info["two"][1] == ["a", "b"]
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)

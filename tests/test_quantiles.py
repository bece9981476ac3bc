"""Exact quantiles, ranks and modes from counts against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.functions.special import chi2_sf, f_sf
from tabforge.operators import quantiles as Q
from tabforge.operators.clean import fit_encoding, fit_modes
from tabforge.spec import FeatureSpec


@pytest.mark.parametrize("ranges", [2, 64])
def test_quantiles(spark, ranges):
    r = np.random.default_rng(1)
    data = {"a": r.normal(size=997), "b": r.integers(0, 4, 500).astype(float), "c": np.array([5.0]), "d": np.array([2.0] * 300 + [7.0])}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("a", None), ("e", None), (None, 3.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "k string, value double").repartition(5)
    counts = df.groupBy("k", "value").agg(F.count(F.lit(1)).alias("cnt"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {x["k"]: x["q"] for x in Q.quantiles(counts, ["k"], probs, ranges).collect()}
    assert set(got) == {"a", "b", "c", "d", None}
    for k, vs in data.items():
        assert got[k] == pytest.approx(list(np.quantile(vs, probs)), rel=1e-12)
    assert got[None] == pytest.approx([3.0, 3.1, 3.25, 3.5, 3.9, 4.0])


def test_tied_values_are_hit_exactly(spark):
    """A quantile between two equal values is that value, not a sum near it."""
    rows = [(f"k{n}-{v}", v, n) for n in range(2, 40) for v in (0.1, 0.07, 1 / 3, 104948.73)]
    counts = spark.createDataFrame(rows, "k string, value double, cnt long")
    got = Q.quantiles(counts, ["k"], [i / 10 for i in range(11)]).collect()
    assert len(got) == len(rows)
    assert {x["k"]: set(x["q"]) for x in got} == {k: {v} for k, v, _ in rows}


def test_ranks_outside_are_null(spark):
    counts = spark.createDataFrame([("x", 1.0, 2), ("x", 4.0, 1)], "k string, value double, cnt long")
    r = Q.at_ranks(counts, ["k"], [lambda n: F.lit(-1), lambda n: n - 1, lambda n: n]).first()
    assert (r["n"], r["v0"], r["v1"], r["v2"]) == (3, None, 4.0, None)


def test_modes_and_levels(spark):
    df = spark.createDataFrame([(1, "b", 3), (1, "a", 3), (2, "b", None), (2, "a", None), (None, None, None)], "i int, s string, e int")
    df = df.withColumn("none", F.lit(None).cast("string"))
    assert fit_modes(df, ["i", "s", "e", "none"]) == {"i": 1, "s": "a", "e": 3, "none": "0"}
    levels = fit_encoding(df, FeatureSpec(key=(), categorical=("i", "s", "none")))
    assert {c: v for c, (_, v) in levels.items()} == {"i": [1, 2], "s": ["a", "b"], "none": []}


def test_tails():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-10)
    assert chi2_sf(0.5, 4) == pytest.approx(math.exp(-0.25) * 1.25, rel=1e-12)
    assert chi2_sf(900.0, 2) == pytest.approx(math.exp(-450), rel=1e-10)
    assert f_sf(4.0, 2, 10) == pytest.approx((1 + 2 * 4.0 / 10) ** -5, rel=1e-12)
    # F(1, n) tends to the chi-square tail
    assert f_sf(3.841458820694124, 1, 6e11) == pytest.approx(0.05, rel=1e-9)
    assert f_sf(100.0, 3, 1e12) == pytest.approx(chi2_sf(300.0, 3), rel=1e-7)


def test_ranges_by_two_looks_at_the_cuts(spark):
    """The number of cuts below a value, for any number of cuts, without a lambda over the array."""
    rows = [(n, float(v), [float(2 * i) for i in range(n)]) for n in (0, 1, 5, 16, 62, 63) for v in (-1, 0, 1, 2, 7, 31, 32, 33, 64, 122, 123, 124, 200)]
    got = spark.createDataFrame(rows, "n int, value double, cuts array<double>").withColumn("range", Q.range_of(F.col("value"), "cuts", 63))
    assert all(r["range"] == sum(c < r["value"] for c in r["cuts"]) for r in got.collect())
    counts = spark.range(500).select(F.lit("a").alias("column"), F.col("id").cast("double").alias("value"), F.lit(1).cast("long").alias("cnt"))
    plan = Q.quantiles(counts, ["column"], [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan

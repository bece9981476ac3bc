"""Curve metrics against brute-force computations on small fixtures, and
partition/bucket invariance of the scalable running totals."""

import random

import pytest
from pyspark.sql import functions as F

from tabforge.operators import metrics as V


def brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    tot = 0.0
    for p in pos:
        for n in neg:
            tot += 1.0 if p > n else 0.5 if p == n else 0.0
    return tot / (len(pos) * len(neg))


def brute_ap(ys, ss):
    thr = sorted(set(ss), reverse=True)
    P = sum(ys)
    ap, prev_r = 0.0, 0.0
    for t in thr:
        tp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 1)
        fp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


def brute_roc(ys, ss, drop=True):
    thr = sorted(set(ss), reverse=True)
    P, N = sum(ys), len(ys) - sum(ys)
    fps = [sum(1 for y, s in zip(ys, ss) if s >= t and y == 0) for t in thr]
    tps = [sum(1 for y, s in zip(ys, ss) if s >= t and y == 1) for t in thr]
    keep = list(range(len(thr)))
    if drop and len(thr) > 2:
        keep = [0] + [i for i in range(1, len(thr) - 1)
                      if (fps[i + 1] - 2 * fps[i] + fps[i - 1]) or (tps[i + 1] - 2 * tps[i] + tps[i - 1])] + [len(thr) - 1]
    return sorted([(None, 0.0, 0.0)] + [(thr[i], fps[i] / N, tps[i] / P) for i in keep],
                  key=lambda x: (x[0] is not None, x[0] or 0))


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(7)
    ys = [rnd.randint(0, 1) for _ in range(400)]
    ss = [round(rnd.random() * (0.6 + 0.4 * y), 2) for y in ys]      # many ties
    return ys, ss


def test_auc_ap_match_brute_force(spark, data):
    ys, ss = data
    df = spark.createDataFrame(list(zip(ys, ss)), "y int, s double").repartition(5)
    for b in (1, 3, 16):
        g = V.score_table(df, "y", "s")
        c = V.running_totals(g, buckets=b)
        r = c.agg((F.sum(F.col("n") * (F.col("cp") - F.col("p") / 2)) / (F.max("tp_tot") * F.max("tn_tot"))).alias("auc"),
                  F.sum(F.col("p") / F.col("tp_tot") * (F.col("cp") / (F.col("cp") + F.col("cn")))).alias("ap")).first()
        assert r["auc"] == pytest.approx(brute_auc(ys, ss), abs=1e-12)
        assert r["ap"] == pytest.approx(brute_ap(ys, ss), abs=1e-12)
    one = V.auc_ap(df, "y", "s").first()
    assert one["roc_auc"] == pytest.approx(brute_auc(ys, ss), abs=1e-12)


def test_roc_curve_drop_intermediate(spark, data):
    ys, ss = data
    df = spark.createDataFrame(list(zip(ys, ss)), "y int, s double")
    got = sorted([(r["threshold"], r["fpr"], r["tpr"]) for r in V.roc_curve(df, "y", "s").collect()],
                 key=lambda x: (x[0] is not None, x[0] or 0))
    exp = brute_roc(ys, ss)
    assert len(got) == len(exp)
    for a, b in zip(got, exp):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1]) and a[2] == pytest.approx(b[2])


def test_grouped_auc_independent(spark, data):
    ys, ss = data
    rows = [("m1", y, s) for y, s in zip(ys, ss)] + [("m2", y, 1 - s) for y, s in zip(ys, ss)]
    df = spark.createDataFrame(rows, "model string, y int, s double")
    r = {x["model"]: x["roc_auc"] for x in V.auc_ap(df, "y", "s", ["model"]).collect()}
    assert r["m1"] == pytest.approx(brute_auc(ys, ss))
    assert r["m2"] == pytest.approx(1 - brute_auc(ys, ss))


def test_class_report_and_weighted(spark):
    rows = [(1, 1)] * 26 + [(1, 0)] * 2 + [(0, 1)] * 6 + [(0, 0)] * 27
    df = spark.createDataFrame(rows, "y int, pred int")
    rep = {r["label"]: r for r in V.class_report(df, "y", "pred").collect()}
    assert rep["1"]["precision"] == pytest.approx(26 / 32) and rep["1"]["recall"] == pytest.approx(26 / 28)
    assert rep["0"]["support"] == 33 and rep["accuracy"]["f1"] == pytest.approx(53 / 61)
    w = V.weighted_metrics(df, "y", "pred").first()
    exp_p = (33 * (27 / 29) + 28 * (26 / 32)) / 61
    assert w["precision_weighted"] == pytest.approx(exp_p)

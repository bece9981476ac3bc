"""How often the shared steps read or move the rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import clean as C
from tabforge.operators import logit as L
from tabforge.operators import select as SEL
from tabforge.operators import split as S
from tabforge.operators import stats as ST
from tabforge.operators.quantiles import at_ranks
from tabforge.spec import FeatureSpec

from .conftest import SF_SMALL


def test_ranks_count_the_values_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    values = spark.range(3000).select((F.col("id") % 700).alias("value")).mapInArrow(look, "value long")
    counts = values.groupBy(F.lit("a").alias("k"), "value").agg(F.count(F.lit(1)).alias("cnt"))
    row = at_ranks(counts, ["k"], [lambda n: F.lit(0), lambda n: n - 1]).collect()[0]
    assert (row["n"], row["v0"], row["v1"]) == (3000, 0, 699)
    assert seen.value == 3000


@pytest.mark.parametrize("n", [1, 7, 5000])
def test_split_moves_few_rows(spark, monkeypatch, n):
    """The exact ranks of every class, from the ranges of the hashes' first bits alone."""
    plans, inner = [], S.ranks_in

    def spy(*args, **kw):
        out = inner(*args, **kw)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(S, "ranks_in", spy)
    spec = FeatureSpec(key=("id",), numeric=(), categorical=(), target="y")
    df = spark.range(n).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    got = S.add_folds(S.add_split(df, spec), spec).withColumn("h", S.key_hash(["id"], 42)).collect()
    assert len(plans) == 2 and all("BroadcastHashJoin" in p for p in plans)
    for y in {r["y"] for r in got}:
        rows = sorted((r["h"], r["split"]) for r in got if r["y"] == y)
        tests = int(0.2 * len(rows) + 0.5)
        assert [s for _, s in rows] == ["test"] * tests + ["train"] * (len(rows) - tests)
        folds = np.bincount([r["fold"] for r in got if r["y"] == y], minlength=5)
        assert folds.max() - folds.min() <= 1


def test_elimination_takes_few_passes(spark, monkeypatch):
    """A size's fits start from the last size's and end where a step gains nothing but rounding."""
    r = random.Random(4)
    rows = [(i % 5, float(r.random() < 0.5 + 0.02 * (i % 3)), *[r.gauss(0, 1) + 0.1 * (i % 3) for _ in range(6)]) for i in range(3000)]
    cols = [f"x{j}" for j in range(6)]
    df = spark.createDataFrame(rows, ["fold", "label", *cols])
    passes, inner = [], L.sums_of
    monkeypatch.setattr(L, "sums_of", lambda *a: passes.append(1) or inner(*a))
    models = [L.Spec(f, tuple(range(6))) for f in range(5)] + [L.Spec(None, tuple(range(6)))]
    with L.FoldedLogit(df, cols, "label") as data:
        sizes = list(L.eliminate(data, models))
        path = sizes[-3][0]
        assert len(sizes) == 6 and len(passes) <= 6 * 4
        warm = data.fit(path, start=[np.full(len(m.cols) + 1, 0.05) for m in path])
        for a, b in zip(data.fit(path), warm):                  # the start does not matter
            assert np.allclose(a, b, atol=1e-8)


def test_selections_are_evaluated_together(spark, monkeypatch):
    """The fits of all selections share their passes; equal ones are fitted once."""
    r = random.Random(5)
    rows = [(i % 5, float(r.random() < 0.5 + 0.02 * (i % 3)), *[r.gauss(0, 1) + 0.2 * (i % 3) for _ in range(4)]) for i in range(2000)]
    cols = [f"x{j}" for j in range(4)]
    df = spark.createDataFrame(rows, ["fold", "label", *cols])
    picks = {"anova_f": ["x0", "x1"], "chi2_scores": ["x0", "x1"], "mutual_info_knn": ["x2"], "rfe": ["x3", "x1"], "rf_importance": ["x1"], "corr_filter": cols}

    def pick(name):
        t = spark.createDataFrame([(f, True, False) for f in picks[name]], "feature string, selected boolean, removed boolean")
        return lambda *a, **kw: (t, {}) if name == "rfe" else t

    alone = {tuple(v): SEL.subset_eval(df, v, "label") for v in picks.values()}
    for name in picks:
        monkeypatch.setattr(SEL, name, pick(name))
    passes, inner = [], L.sums_of
    monkeypatch.setattr(L, "sums_of", lambda *a: passes.append(a[2]) or inner(*a))
    sel, comp = SEL.compare_selectors(df, cols, [], "label", key=["fold"])
    assert len(passes) <= 8 and max(passes) == 6 * 5
    for (name, fs), row in zip(picks.items(), comp.orderBy("ord").collect()):
        e = alone[tuple(fs)]
        assert (row["n_features"], row["error"]) == (len(fs), None)
        assert (row["cv_mean"], row["cv_std"], row["train_accuracy"]) == pytest.approx((e["cv_mean"], e["cv_std"], e["train_accuracy"]))
    assert sel.count() == sum(map(len, picks.values()))

    one = SEL.subset_evals

    def fails(df, subsets, *a, **kw):
        if ["x2"] in subsets:
            raise ValueError("no fit of x2")
        return one(df, subsets, *a, **kw)

    monkeypatch.setattr(SEL, "subset_evals", fails)
    sel, comp = SEL.compare_selectors(df, cols, [], "label", key=["fold"])
    assert [r["error"] for r in comp.orderBy("ord").collect()] == [None, None, "ValueError: no fit of x2", None, None, None]
    assert {r["feature"] for r in sel.filter("method = 'mutual_information'").collect()} == set()


@pytest.mark.parametrize("votes, chosen", [({"a": ["x", "y"], "b": ["x"]}, ["x"]), ({"a": ["x"], "b": ["y"], "c": ["z"]}, ["x", "y"])])
def test_votes_run_the_selectors_once(spark, votes, chosen):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    pairs = [(m, f) for m, fs in votes.items() for f in fs]
    sel = spark.createDataFrame(pairs, "method string, feature string").mapInArrow(look, "method string, feature string")
    got = SEL.vote_ensemble(sel, fallback=2).orderBy("rank").collect()
    assert [r["feature"] for r in got] == chosen and [r["rank"] for r in got] == list(range(1, len(chosen) + 1))
    assert seen.value == len(pairs)
    all_of = set.intersection(*map(set, votes.values()))
    assert [r["feature"] for r in SEL.vote_intersection(sel).collect()] == sorted(all_of)
    assert seen.value == 2 * len(pairs)


def test_mutual_information_from_counts(spark):
    """Bins and joint counts come from values counted per class: the rows are read once for either kind of feature."""
    r = random.Random(6)
    rows = [(r.choice([0, 1, 1, None]), r.choice([None, float(r.randint(0, 30))]), r.choice(["p", "q", None])) for _ in range(900)]
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "y int, x double, c string").repartition(3).mapInArrow(look, "y int, x double, c string")
    cuts = np.quantile([x for _, x, _ in rows if x is not None], [i / 10 for i in range(1, 10)])

    def information(pairs):
        pairs = [(b, y) for b, y in pairs if b is not None and y is not None]
        n = len(pairs)
        p = {k: sum(a == k for a in pairs) / n for k in set(pairs)}
        pb, py = ({k: sum(v for a, v in p.items() if a[i] == k) for k in {a[i] for a in p}} for i in (0, 1))
        return sum(v * np.log(v / (pb[b] * py[y])) for (b, y), v in p.items())

    want = {"x": information([(None if x is None else int((x > cuts).sum()), y) for y, x, _ in rows]), "c": information([(c, y) for y, _, c in rows])}
    for numeric, discrete in ((["x"], ["c"]), (["x"], []), ([], ["c"])):
        seen.value = 0
        got = {t["feature"]: t["score"] for t in ST.mutual_info(df, numeric, discrete, "y").collect()}
        assert got == pytest.approx({f: want[f] for f in numeric + discrete})
        assert seen.value == 900 * (len(numeric) + len(discrete))


@pytest.mark.parametrize("name", ["binary_metrics", "vote_ensemble"])
def test_written_rows_have_no_unused_key(spark, monkeypatch, name):
    from __spark_entry__ import queries
    written, inner = [], C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, what: written.append(df.columns) or inner(df, what))
    assert queries()[name](spark, SF_SMALL).count() > 0
    assert len(written) == 1 and "l_orderkey" not in written[0]


@pytest.mark.parametrize("name", ["registry_roundtrip", "stream_score"])
def test_rows_are_cleaned_once(spark, monkeypatch, name):
    from __spark_entry__ import queries
    fits, inner = [], C.fit_fill_values
    monkeypatch.setattr(C, "fit_fill_values", lambda *a, **kw: fits.append(1) or inner(*a, **kw))
    assert queries()[name](spark, SF_SMALL).count() > 0
    assert len(fits) == 1


def test_svm_needs_few_passes(monkeypatch):
    """Kernel features of very unequal spread do not slow the search; single
    precision serves where the projection allows it, and equal landmarks do not."""
    import numpy as np
    from tabforge.operators import classify as M
    from tabforge.operators import hinge as HG

    r = np.random.default_rng(4)
    n = 20000
    x = r.normal(size=(n, 4))
    y = (x[:, 0] ** 2 + x[:, 1] * x[:, 2] + r.normal(size=n) > 1.0).astype(float)
    L = x[:60]
    w, U = np.linalg.eigh(M.kernel_matrix(L, L, "rbf", 0.25))
    proj = U / np.sqrt(w) @ U.T
    kernel, single = (lambda v: M.kernel_matrix(v, L, "rbf", 0.25)), M.rbf_values(L, 0.25)
    assert single(x).dtype == np.float32 and np.abs(single(x) - kernel(x)).max() < 1e-5
    assert M.rounds_well("rbf", proj) and not M.rounds_well("rbf", np.eye(2) * 1e6) and not M.rounds_well("poly", proj)
    passes = []

    def local(rows, per_batch, models, read):                  # the task's part of a pass, here
        passes.append(models)
        return dict(enumerate(per_batch(iter(rows))))

    monkeypatch.setattr(HG, "sums_of", local)
    fold = np.arange(n, dtype=np.int32) % 2
    blocks = [([fold[i:i + 5000].tobytes(), y[i:i + 5000].tobytes()], [c[i:i + 5000].tobytes() for c in x.T.copy()]) for i in range(0, n, 5000)]
    (w, b), left_out = HG.fit_hinge(blocks, [None, 0], single, proj, [1 / n, 2 / n], 2)
    assert len(passes) < 100                                   # some 200 in the plain directions
    z = kernel(x) @ proj

    def objective(w, b, on=slice(None)):
        rows = z[on]
        return np.maximum(0, 1 - (2 * y[on] - 1) * (rows @ w + b)).mean() + 0.5 / len(rows) * ((w * rows.std(0, ddof=1)) ** 2).sum()

    # no worse than the points around it along its subgradient, and each is the best of its own rows
    sign, sd = 2 * y - 1, z.std(0, ddof=1)
    on = (1 - sign * (z @ w + b) > 0) * -sign
    for t in (1e-4, 1e-3, 1e-2):
        assert objective(w, b) <= objective(w - t * (z.T @ on / n + w * sd ** 2 / n) / sd ** 2, b - t * on.mean()) * (1 + 1e-4)
    assert objective(w, b) < objective(*left_out) and objective(*left_out, on=fold == 1) < objective(w, b, on=fold == 1)

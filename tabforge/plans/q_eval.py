"""Evaluation-metric queries (V1-V11) on rule-scored orderlines.

Fixed-rule "models" give deterministic scores, so the oracle can score
the same rows: each model maps one cleaned column to [0, 1]; the predicted
class is score >= 0.5.  The label is the binarised order status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics as V
from .catalog import query
from .q_clean import cleaned_orderlines
from .sqlparts import OL_CLEAN_CHAIN, r6, union_all, with_

# The rule models (column, divisor) and the decision threshold.
RULE_MODELS = {"price": ("l_extendedprice", 105000.0), "discount": ("l_discount", 0.1),
               "quantity": ("l_quantity", 50.0), "tax": ("l_tax", 0.08)}
THRESHOLD = 0.5
MAIN = "price"


def scored(spark, sf_dir, only: tuple | None = None) -> DataFrame:
    """Long (model, y, s, pred) over every cleaned row and every rule model
    (or only the models in ``only``; the cleaning fit then covers just their columns)."""
    chosen = {m: v for m, v in RULE_MODELS.items() if only is None or m in only}
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=tuple(c for c, _ in chosen.values()), categorical=(), keyed=False)
    models = F.array(*[F.struct(F.lit(m).alias("model"), (F.col(c) / F.lit(d)).alias("s"))
                       for m, (c, d) in chosen.items()])
    return (cl.select(F.col(spec.target).alias("y"), F.explode(models).alias("m"))
              .select("m.model", "y", "m.s", (F.col("m.s") >= THRESHOLD).cast("int").alias("pred")))


def scored_main(spark, sf_dir) -> DataFrame:
    return scored(spark, sf_dir, only=(MAIN,))


SC = "sc AS (" + union_all(
    f"SELECT '{m}' AS model, severity AS y, {c} / CAST({d} AS DOUBLE) AS s, "
    f"CAST({c} / CAST({d} AS DOUBLE) >= {THRESHOLD} AS INTEGER) AS pred FROM ol_clean"
    for m, (c, d) in RULE_MODELS.items()) + ")"
SC1 = f"sc1 AS (SELECT * FROM sc WHERE model = '{MAIN}')"
CM_COLS = ("count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp, "
           "count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp")


def _d(n, d):
    return f"coalesce(CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0), 0)"


BIN_COLS = ", ".join(f"{r6(e)} AS {a}" for a, e in [
    ("accuracy", _d("tp + tn", "tn + fp + fn + tp")), ("precision", _d("tp", "tp + fp")),
    ("recall", _d("tp", "tp + fn")), ("f1", _d("2 * tp", "2 * tp + fp + fn")),
    ("specificity", _d("tn", "tn + fp")), ("sensitivity", _d("tp", "tp + fn")),
    ("ppv", _d("tp", "tp + fp")), ("npv", _d("tn", "tn + fn"))])


BIN_RAW = ", ".join(f"{e} AS {a}" for a, e in [
    ("accuracy", _d("tp + tn", "tn + fp + fn + tp")), ("precision", _d("tp", "tp + fp")),
    ("recall", _d("tp", "tp + fn")), ("f1", _d("2 * tp", "2 * tp + fp + fn"))])


@query("confusion", with_(*OL_CLEAN_CHAIN, SC, SC1) + f"SELECT {CM_COLS} FROM sc1")
def q_confusion(spark, sf_dir):
    return V.confusion(scored_main(spark, sf_dir), "y", "pred")


@query("binary_metrics", with_(*OL_CLEAN_CHAIN, SC, f"cm AS (SELECT model, {CM_COLS} FROM sc GROUP BY model)") +
       f"SELECT model, tn, fp, fn, tp, {BIN_COLS} FROM cm")
def q_binary_metrics(spark, sf_dir):
    return V.binary_metrics(scored(spark, sf_dir), "y", "pred", ["model"])


CUM = ("g AS (SELECT model, s, CAST(sum(y) AS DOUBLE) AS p, CAST(sum(1 - y) AS DOUBLE) AS n FROM sc GROUP BY model, s)",
       "c AS (SELECT *, sum(p) OVER (PARTITION BY model ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp, "
       "sum(n) OVER (PARTITION BY model ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn, "
       "sum(p) OVER (PARTITION BY model) AS tpt, sum(n) OVER (PARTITION BY model) AS tnt, "
       "lead(p) OVER (PARTITION BY model ORDER BY s DESC) AS np_, lead(n) OVER (PARTITION BY model ORDER BY s DESC) AS nn_ FROM g)")


@query("roc_auc", with_(*OL_CLEAN_CHAIN, SC, *CUM) +
       f"SELECT model, {r6('sum(n * (cp - p / 2)) / (max(tpt) * max(tnt))')} AS roc_auc FROM c GROUP BY model")
def q_roc_auc(spark, sf_dir):
    return V.auc_ap(scored(spark, sf_dir), "y", "s", ["model"]).select("model", "roc_auc")


@query("avg_precision", with_(*OL_CLEAN_CHAIN, SC, *CUM) +
       f"SELECT model, {r6('sum(p / tpt * (cp / (cp + cn)))')} AS avg_precision, {r6('max(tpt) / (max(tpt) + max(tnt))')} AS baseline "
       "FROM c GROUP BY model")
def q_avg_precision(spark, sf_dir):
    sc = scored(spark, sf_dir)
    base = sc.groupBy("model").agg(F.avg(F.col("y").cast("double")).alias("baseline"))
    return V.auc_ap(sc, "y", "s", ["model"]).select("model", "avg_precision").join(base, "model")


@query("roc_curve", with_(*OL_CLEAN_CHAIN, SC, *CUM) +
       f"""SELECT model, {r6('s')} AS threshold, {r6('cn / tnt')} AS fpr, {r6('cp / tpt')} AS tpr FROM c
WHERE (cp = p AND cn = n) OR np_ IS NULL OR np_ <> p OR nn_ <> n
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM sc""")
def q_roc_curve(spark, sf_dir):
    return V.roc_curve(scored(spark, sf_dir), "y", "s", ["model"])


@query("pr_curve", with_(*OL_CLEAN_CHAIN, SC, SC1.replace("sc1", "scx"), *[x.replace("FROM sc ", "FROM scx ") for x in CUM]) +
       f"SELECT model, {r6('s')} AS threshold, {r6('cp / (cp + cn)')} AS precision, {r6('cp / tpt')} AS recall, "
       f"{r6('tpt / (tpt + tnt)')} AS baseline FROM c")
def q_pr_curve(spark, sf_dir):
    return V.pr_curve(scored_main(spark, sf_dir), "y", "s", ["model"])


CLS = (
    "cells AS (SELECT y, pred AS pr, count(*) AS c FROM sc1 GROUP BY y, pred)",
    "per_y AS (SELECT y AS cls, sum(c) AS support, sum(CASE WHEN y = pr THEN c END) AS tp FROM cells GROUP BY y)",
    "per_p AS (SELECT pr AS cls, sum(c) AS predicted FROM cells GROUP BY pr)",
    "cl AS (SELECT CAST(coalesce(per_y.cls, per_p.cls) AS VARCHAR) AS label, coalesce(support, 0) AS support, "
    "coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted FROM per_y FULL JOIN per_p ON per_y.cls = per_p.cls)",
    f"m AS (SELECT label, support, tp, {_d('tp', 'predicted')} AS precision, {_d('tp', 'support')} AS recall FROM cl)",
    f"f AS (SELECT *, {_d('2 * precision * recall', 'precision + recall')} AS f1 FROM m)")
CLS_SQL = union_all([
    f"SELECT label, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1, CAST(support AS BIGINT) AS support FROM f",
    f"SELECT 'accuracy', NULL, NULL, {r6('sum(tp) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM f",
    f"SELECT 'macro avg', {r6('avg(precision)')}, {r6('avg(recall)')}, {r6('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM f",
    f"SELECT 'weighted avg', {r6('sum(precision * support) / sum(support)')}, {r6('sum(recall * support) / sum(support)')}, "
    f"{r6('sum(f1 * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM f"])


@query("class_report", with_(*OL_CLEAN_CHAIN, SC, SC1, *CLS) + CLS_SQL)
def q_class_report(spark, sf_dir):
    return V.class_report(scored_main(spark, sf_dir), "y", "pred")


@query("weighted_metrics", with_(*OL_CLEAN_CHAIN, SC, SC1, *CLS,
                                 *[x.replace("FROM sc ", "FROM sc1 ") for x in CUM]) +
       f"""SELECT {r6('(SELECT sum(tp) / sum(support) FROM f)')} AS accuracy,
  {r6('(SELECT sum(precision * support) / sum(support) FROM f)')} AS precision_weighted,
  {r6('(SELECT sum(recall * support) / sum(support) FROM f)')} AS recall_weighted,
  {r6('(SELECT sum(f1 * support) / sum(support) FROM f)')} AS f1_weighted,
  {r6('(SELECT sum(n * (cp - p / 2)) / (max(tpt) * max(tnt)) FROM c)')} AS roc_auc""")
def q_weighted_metrics(spark, sf_dir):
    return V.weighted_metrics(scored_main(spark, sf_dir), "y", "pred", "s")


_OVERALL = " + ".join(f"{w} * {m}" for m, w in V.OVERALL_WEIGHTS.items())
_ORDER = ", ".join(f"('{m}', {i})" for i, m in enumerate(RULE_MODELS))


@query("compare_models", with_(*OL_CLEAN_CHAIN, SC, *CUM,
                               f"cm AS (SELECT model, {CM_COLS} FROM sc GROUP BY model)",
                               f"bm AS (SELECT model, {BIN_RAW} FROM cm)",
                               "au AS (SELECT model, sum(n * (cp - p / 2)) / (max(tpt) * max(tnt)) AS roc_auc, "
                               "sum(p / tpt * (cp / (cp + cn))) AS avg_precision FROM c GROUP BY model)") +
       f"""SELECT bm.model, {r6('accuracy')} AS accuracy, {r6('precision')} AS precision, {r6('recall')} AS recall,
  {r6('f1')} AS f1, {r6('roc_auc')} AS roc_auc, {r6('avg_precision')} AS avg_precision,
  {r6(_OVERALL)} AS overall_score
FROM bm JOIN au ON bm.model = au.model""")
def q_compare_models(spark, sf_dir):
    sc = scored(spark, sf_dir)
    return compare_table(sc)


def compare_table(sc: DataFrame) -> DataFrame:
    bm = V.binary_metrics(sc, "y", "pred", ["model"])
    au = V.auc_ap(sc, "y", "s", ["model"])
    overall = sum(F.col(m) * w for m, w in V.OVERALL_WEIGHTS.items())
    return bm.join(au, "model").select("model", "accuracy", "precision", "recall", "f1", "roc_auc",
                                       "avg_precision", overall.alias("overall_score"))


METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "avg_precision", "overall_score"]


def _insights_sql() -> str:
    best = lambda m: f"arg_max(model, struct_pack(v := {m}, o := -ord))"
    items = [("best", "overall", best("overall_score")), ("best", "score", "printf('%.4f', max(overall_score))")] + \
        [("reason", k, f"any_value('{v}')") for k, v in V.USE_CASE_REASONS.items()] + \
        [("use_case", k, best(m)) for k, m in V.USE_CASES]
    acc = ("CASE WHEN avg(accuracy) > {0} THEN '{1}' WHEN avg(accuracy) > {2} THEN '{3}' ELSE '{4}' END"
           .format(V.ACCURACY_INSIGHTS[0][0], V.ACCURACY_INSIGHTS[0][1], V.ACCURACY_INSIGHTS[1][0],
                   V.ACCURACY_INSIGHTS[1][1], V.ACCURACY_FLOOR))
    items += [("insight", "accuracy", acc),
              ("insight", "imbalance",
               f"CASE WHEN abs(avg(precision) - avg(recall)) > {V.IMBALANCE_GAP} THEN '{V.IMBALANCE_TEXT}' END")]
    items += [("suggestion", str(i), f"CASE WHEN avg(accuracy) < {V.SUGGEST_BELOW} THEN '{s}' END")
              for i, s in enumerate(V.SUGGESTIONS)]
    rows = union_all(f"SELECT '{k}' AS kind, '{n}' AS name, {e} AS text FROM t" for k, n, e in items)
    return f"SELECT * FROM ({rows}) WHERE text IS NOT NULL"


@query("model_insights", with_(*OL_CLEAN_CHAIN, SC, *CUM,
                               f"cm AS (SELECT model, {CM_COLS} FROM sc GROUP BY model)",
                               f"bm AS (SELECT model, {BIN_RAW} FROM cm)",
                               "au AS (SELECT model, sum(n * (cp - p / 2)) / (max(tpt) * max(tnt)) AS roc_auc "
                               "FROM c GROUP BY model)",
                               f"t AS (SELECT bm.*, au.roc_auc, {_OVERALL} AS overall_score, o.ord "
                               f"FROM bm JOIN au ON bm.model = au.model JOIN (VALUES {_ORDER}) o(model, ord) "
                               "ON bm.model = o.model)") + _insights_sql())
def q_model_insights(spark, sf_dir):
    """Best model overall and per use case, insights and suggestions."""
    t = compare_table(scored(spark, sf_dir))
    order = F.create_map(*[x for i, m in enumerate(RULE_MODELS) for x in (F.lit(m), F.lit(i))])
    return V.model_insights(t.withColumn("ord", order[F.col("model")]))


@query("evaluation_dataset", with_(*OL_CLEAN_CHAIN) + f"""SELECT count(*) AS samples,
  {r6('avg(CAST(severity AS DOUBLE))')} AS positive_class_ratio, count(*) FILTER (WHERE severity = 0) AS negatives,
  count(*) FILTER (WHERE severity = 1) AS positives FROM ol_clean""")
def q_evaluation_dataset(spark, sf_dir):
    """Size and class distribution of the evaluated rows."""
    y = F.col("y")
    return scored_main(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("samples"), F.avg(y.cast("double")).alias("positive_class_ratio"),
        F.count_if(y == 0).alias("negatives"), F.count_if(y == 1).alias("positives"))


@query("best_models", with_(*OL_CLEAN_CHAIN, SC, *CUM,
                            f"cm AS (SELECT model, {CM_COLS} FROM sc GROUP BY model)",
                            f"bm AS (SELECT model, {BIN_RAW} FROM cm)",
                            "au AS (SELECT model, sum(n * (cp - p / 2)) / (max(tpt) * max(tnt)) AS roc_auc, "
                            "sum(p / tpt * (cp / (cp + cn))) AS avg_precision FROM c GROUP BY model)",
                            f"t AS (SELECT bm.*, au.roc_auc, au.avg_precision, {_OVERALL} AS overall_score, o.ord "
                            f"FROM bm JOIN au ON bm.model = au.model JOIN (VALUES {_ORDER}) o(model, ord) ON bm.model = o.model)",
                            "lg AS (" + union_all(f"SELECT '{m}' AS metric, model, ord, {m} AS value FROM t" for m in METRICS) + ")") +
       f"""SELECT metric, arg_max(model, struct_pack(v := value, o := -ord)) AS model, {r6('max(value)')} AS value
FROM lg GROUP BY metric""")
def q_best_models(spark, sf_dir):
    """Best model per metric; ties go to the first model in declaration order."""
    t = compare_table(scored(spark, sf_dir))
    order = F.create_map(*[x for i, m in enumerate(RULE_MODELS) for x in (F.lit(m), F.lit(i))])
    items = ", ".join(f"'{m}', `{m}`" for m in METRICS)
    lg = t.select("model", order[F.col("model")].alias("ord"),
                  F.expr(f"stack({len(METRICS)}, {items}) as (metric, value)"))
    return lg.groupBy("metric").agg(
        F.max_by("model", F.struct(F.col("value"), -F.col("ord"))).alias("model"), F.max("value").alias("value"))

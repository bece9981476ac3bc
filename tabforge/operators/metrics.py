"""Evaluation metrics over a predictions DataFrame.

Counting metrics are one aggregate.  Curve metrics (ROC, PR, AUC, AP) work
on the table of DISTINCT scores ``(s, p, n)`` -- already aggregated, so a
score shared by a third of all rows is one row -- and need running sums in
descending score order.  A single global window would pull that table into
one task; instead :func:`running_totals` range-buckets the scores (bucket
bounds from an approximate quantile sketch, bounded by the partition
count), sums each bucket, turns those few per-bucket totals into offsets,
and finishes with a window per bucket.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Overall-score weights and rule thresholds of the model report.
OVERALL_WEIGHTS = {"accuracy": 0.25, "precision": 0.25, "recall": 0.25, "f1": 0.25}


def _div(n, d):
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))


# V1 ------------------------------------------------------------------------
def confusion(df: DataFrame, label: str, pred: str, group: list[str] | None = None) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    aggs = [F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp")]
    return df.groupBy(*(group or [])).agg(*aggs)


# V2 + V3 -------------------------------------------------------------------
def with_binary_metrics(cm: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    prec, rec = _div(tp, tp + fp), _div(tp, tp + fn)
    return cm.select(
        "*",
        _div(tp + tn, tn + fp + fn + tp).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
        _div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _div(tn, tn + fp).alias("specificity"), rec.alias("sensitivity"),
        prec.alias("ppv"), _div(tn, tn + fn).alias("npv"))


def binary_metrics(df: DataFrame, label: str, pred: str, group: list[str] | None = None) -> DataFrame:
    return with_binary_metrics(confusion(df, label, pred, group))


# curves --------------------------------------------------------------------
def score_table(df: DataFrame, label: str, score: str, group: list[str] | None = None) -> DataFrame:
    """(group..., s, p, n): positives and negatives per distinct score."""
    y = F.col(label).cast("double")
    return (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
              .groupBy(*(group or []), F.col(score).cast("double").alias("s"))
              .agg(F.sum(y).alias("p"), F.sum(F.lit(1.0) - y).alias("n")))


def running_totals(g: DataFrame, group: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Add cp, cn (cumulative p, n for scores >= s), tp_tot, tn_tot, and the
    next-lower score's (p, n) as np_, nn_ -- all per group, scalably."""
    group = list(group or [])
    spark = g.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # g (distinct scores) feeds the bucket-bound sketch and the final pass:
    # written once instead of recomputing the scoring pipeline twice.
    g = materialize(g, "scores")
    probs = [i / buckets for i in range(1, buckets)]
    cuts = g.agg(F.percentile_approx("s", probs, 10000).alias("q")).first()["q"] if probs else []
    splits = sorted(set(float(c) for c in (cuts or []) if c is not None))
    if splits:
        splits = [float("-inf")] + splits + [float("inf")]
        b = Bucketizer(splits=splits, inputCol="s", outputCol="_b", handleInvalid="keep").transform(g) \
            .withColumn("_b", F.col("_b").cast("int"))
    else:  # one bucket (a single distinct score, or buckets=1)
        b = g.withColumn("_b", F.lit(0))
    # per (group, bucket) totals and the bucket's highest-score row -- tiny
    tot = b.groupBy(*group, "_b").agg(F.sum("p").alias("_bp"), F.sum("n").alias("_bn"),
                                      F.max_by("p", "s").alias("_fp"), F.max_by("n", "s").alias("_fn"))
    wo = Window.partitionBy(*group).orderBy(F.desc("_b"))
    tot = (tot.withColumn("_op", F.coalesce(F.sum("_bp").over(wo.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("_on", F.coalesce(F.sum("_bn").over(wo.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("tp_tot", F.sum("_bp").over(Window.partitionBy(*group)))
              .withColumn("tn_tot", F.sum("_bn").over(Window.partitionBy(*group)))
              .withColumn("_xp", F.lead("_fp").over(wo))
              .withColumn("_xn", F.lead("_fn").over(wo))
              .drop("_bp", "_bn", "_fp", "_fn"))
    wb = Window.partitionBy(*group, "_b").orderBy(F.desc("s"))
    run = wb.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = b.join(tot, [*group, "_b"])
    return (out.withColumn("cp", F.col("_op") + F.sum("p").over(run))
               .withColumn("cn", F.col("_on") + F.sum("n").over(run))
               .withColumn("np_", F.coalesce(F.lead("p").over(wb), F.col("_xp")))
               .withColumn("nn_", F.coalesce(F.lead("n").over(wb), F.col("_xn")))
               .drop("_op", "_on", "_xp", "_xn", "_b"))


# V5 + V6 -------------------------------------------------------------------
def auc_ap(df: DataFrame, label: str, score: str, group: list[str] | None = None) -> DataFrame:
    """Exact ROC-AUC (ties count one half) and average precision sum (R_n - R_n-1) P_n."""
    c = running_totals(score_table(df, label, score, group), group)
    return c.groupBy(*(group or [])).agg(
        (F.sum(F.col("n") * (F.col("cp") - F.col("p") / 2)) / (F.max("tp_tot") * F.max("tn_tot"))).alias("roc_auc"),
        F.sum(F.col("p") / F.col("tp_tot") * (F.col("cp") / (F.col("cp") + F.col("cn")))).alias("avg_precision"))


# V4 ------------------------------------------------------------------------
def roc_curve(df: DataFrame, label: str, score: str, group: list[str] | None = None,
              drop_intermediate: bool = True) -> DataFrame:
    """(group..., threshold, fpr, tpr): one point per distinct score (descending)
    plus the (0, 0) start with a NULL threshold.  ``drop_intermediate`` drops
    points on a straight segment (the increments equal the next point's)."""
    group = list(group or [])
    c = running_totals(score_table(df, label, score, group), group)
    first_rows = c.filter((F.col("cp") == F.col("p")) & (F.col("cn") == F.col("n")))
    if drop_intermediate:
        first = F.col("cp") == F.col("p")
        first = first & (F.col("cn") == F.col("n"))
        last = F.col("np_").isNull()
        keep = first | last | (F.col("np_") != F.col("p")) | (F.col("nn_") != F.col("n"))
        c = c.filter(keep)
    pts = c.select(*group, F.col("s").alias("threshold"),
                   _div(F.col("cn"), F.col("tn_tot")).alias("fpr"), _div(F.col("cp"), F.col("tp_tot")).alias("tpr"))
    # a group's start point stands beside its highest score
    start = first_rows.select(*group, F.lit(None).cast("double").alias("threshold"),
                                                F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")) \
        if group else df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return pts.unionByName(start)


def pr_curve(df: DataFrame, label: str, score: str, group: list[str] | None = None) -> DataFrame:
    """(group..., threshold, precision, recall) per distinct score, plus the prevalence baseline."""
    group = list(group or [])
    c = running_totals(score_table(df, label, score, group), group)
    return c.select(*group, F.col("s").alias("threshold"),
                    _div(F.col("cp"), F.col("cp") + F.col("cn")).alias("precision"),
                    _div(F.col("cp"), F.col("tp_tot")).alias("recall"),
                    _div(F.col("tp_tot"), F.col("tp_tot") + F.col("tn_tot")).alias("baseline"))


# V7 ------------------------------------------------------------------------
def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision/recall/f1/support, plus accuracy, macro and weighted averages."""
    y, p = F.col(label), F.col(pred)
    # the confusion cells, one scan; the steps below share its exchange
    cells = df.groupBy(y.alias("y"), p.alias("p")).agg(F.count(F.lit(1)).alias("c"))
    per_y = cells.groupBy(F.col("y").alias("cls")).agg(F.sum("c").alias("support"),
                                                      F.sum(F.when(F.col("y") == F.col("p"), F.col("c"))).alias("tp"))
    per_p = cells.groupBy(F.col("p").alias("cls")).agg(F.sum("c").alias("predicted"))
    cls = (per_y.join(per_p, "cls", "full")
                .select(F.col("cls").cast("string").alias("label"),
                        F.coalesce("support", F.lit(0)).alias("support"),
                        F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("predicted", F.lit(0)).alias("predicted")))
    cls = cls.select("label", "support", "tp",
                     _div(F.col("tp"), F.col("predicted")).alias("precision"),
                     _div(F.col("tp"), F.col("support")).alias("recall"))
    cls = cls.withColumn("f1", _div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    per = cls.select("label", "precision", "recall", "f1", F.col("support").cast("bigint").alias("support"))
    n = F.sum("support")
    weighted = [(F.sum(F.col(m) * F.col("support")) / n).alias(a) for m, a in (("precision", "wp"), ("recall", "wr"), ("f1", "wf"))]
    avg = cls.agg(F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"), *weighted,
                  (F.sum("tp") / n).alias("acc"), n.cast("bigint").alias("n"))
    summary = avg.selectExpr(
        "stack(3, 'accuracy', cast(null as double), cast(null as double), acc, n,"
        " 'macro avg', mp, mr, mf, n, 'weighted avg', wp, wr, wf, n) as (label, precision, recall, f1, support)")
    return per.unionByName(summary)


# V11 / V12 / V13 -----------------------------------------------------------
# Use cases, insight thresholds and texts of the model report.
USE_CASES = (("high_precision_needed", "precision"), ("high_recall_needed", "recall"),
             ("balanced_performance", "f1"), ("probability_ranking", "roc_auc"))
USE_CASE_REASONS = {
    "high_precision_needed": "Best for minimizing false positives (avoiding unnecessary treatments)",
    "high_recall_needed": "Best for minimizing false negatives (catching all disease cases)",
    "balanced_performance": "Best balance between precision and recall",
    "probability_ranking": "Best for ranking patients by disease probability",
}
ACCURACY_INSIGHTS = ((0.85, "Excellent overall model performance (>85% accuracy)"),
                     (0.75, "Good overall model performance (>75% accuracy)"))
ACCURACY_FLOOR = "Model performance needs improvement (<75% accuracy)"
IMBALANCE_GAP = 0.1
IMBALANCE_TEXT = "Significant precision-recall imbalance detected - consider class balancing techniques"
SUGGEST_BELOW = 0.9
SUGGESTIONS = ("Consider hyperparameter tuning for better performance",
               "Explore feature engineering and selection techniques",
               "Try ensemble methods to combine model strengths")


def model_insights(table: DataFrame, order: str = "ord") -> DataFrame:
    """Report rows (kind, name, text) from a per-model metrics table with
    accuracy/precision/recall/f1/roc_auc and an insertion-order column:
    overall best by the weighted score and that score, best model per use case
    (ties -> first model) and the reason, accuracy insight, precision/recall
    imbalance, suggestions."""
    overall = sum(F.col(m) * w for m, w in OVERALL_WEIGHTS.items())
    t = table.withColumn("_overall", overall)
    best = [F.max_by("model", F.struct(F.col("_overall"), -F.col(order))).alias("overall_best")]
    best += [F.max_by("model", F.struct(F.col(m), -F.col(order))).alias(k) for k, m in USE_CASES]
    avg_acc = F.avg("accuracy")
    acc_text = F.when(avg_acc > ACCURACY_INSIGHTS[0][0], F.lit(ACCURACY_INSIGHTS[0][1])) \
        .when(avg_acc > ACCURACY_INSIGHTS[1][0], F.lit(ACCURACY_INSIGHTS[1][1])).otherwise(F.lit(ACCURACY_FLOOR))
    one = t.agg(*best, F.format_string("%.4f", F.max("_overall")).alias("best_score"), acc_text.alias("acc_text"),
                (F.abs(F.avg("precision") - F.avg("recall")) > IMBALANCE_GAP).alias("imbalanced"),
                (avg_acc < SUGGEST_BELOW).alias("suggest"))
    items = [("'best'", "'overall'", "overall_best"), ("'best'", "'score'", "best_score")]
    items += [("'reason'", f"'{k}'", f"'{v}'") for k, v in USE_CASE_REASONS.items()]
    items += [("'use_case'", f"'{k}'", k) for k, _ in USE_CASES]
    items += [("'insight'", "'accuracy'", "acc_text"),
              ("'insight'", "'imbalance'", f"if(imbalanced, '{IMBALANCE_TEXT}', cast(null as string))")]
    items += [("'suggestion'", f"'{i}'", f"if(suggest, '{s}', cast(null as string))")
              for i, s in enumerate(SUGGESTIONS)]
    stack = ", ".join(f"{a}, {b}, {c}" for a, b, c in items)
    return one.selectExpr(f"stack({len(items)}, {stack}) as (kind, name, text)").filter("text is not null")


# V8 ------------------------------------------------------------------------
def weighted_metrics(df: DataFrame, label: str, pred: str, score: str | None = None) -> DataFrame:
    """accuracy, precision/recall/F1 weighted by class support[, roc_auc] -- one row."""
    rep = class_report(df, label, pred)
    # the report has <= classes+3 rows: pivot its two summary rows into one
    one = rep.filter(F.col("label").isin("accuracy", "weighted avg")).agg(
        F.max(F.when(F.col("label") == "accuracy", F.col("f1"))).alias("accuracy"),
        F.max(F.when(F.col("label") == "weighted avg", F.col("precision"))).alias("precision_weighted"),
        F.max(F.when(F.col("label") == "weighted avg", F.col("recall"))).alias("recall_weighted"),
        F.max(F.when(F.col("label") == "weighted avg", F.col("f1"))).alias("f1_weighted"))
    if score is None:
        return one
    # two one-row frames combined by stacking and one aggregate (no join)
    auc = auc_ap(df, label, score).select("roc_auc")
    both = one.unionByName(auc, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in
                      ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "roc_auc")])

"""Scoring and rule-based interpretation.

All interpretation is Column expressions over the scored rows: confidence
bands, risk categories, factor arrays, explanation text and population
percentiles fuse into the same projection as the model output.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import rules as RL
from .common import column_moments


# P6 ------------------------------------------------------------------------
def request_error(req: Column, rules: dict, labels: dict) -> Column:
    """First failing check of a request map<string,string>, in key order, or NULL.

    Checks per key: unknown feature; for numeric rules 'must be a number' and
    'must be between lo and hi'; for option rules 'Invalid value for ...'.
    """
    known = list(rules)

    def check(k):
        v = req[k]
        out = F.when(~k.isin(known), F.concat(F.lit("Unknown feature: "), k))
        for name, rule in rules.items():
            label = labels.get(name, name)
            if rule[0] == "range":
                lo, hi = rule[1], rule[2]
                num = v.try_cast("double")
                out = (out.when((k == name) & num.isNull(), F.lit(f"{label} must be a number"))
                          .when((k == name) & ((num < lo) | (num > hi)),
                                F.lit(f"{label} must be between {lo} and {hi}")))
            else:
                opts = [str(o) for o in rule[1]]
                num_opts = all(isinstance(o, (int, float)) for o in rule[1])
                val = v.try_cast("double") if num_opts else v
                allowed = [float(o) for o in rule[1]] if num_opts else opts
                out = out.when((k == name) & (val.isNull() | ~val.isin(allowed)),
                               F.lit(f"Invalid value for {label}"))
        return out

    return F.try_element_at(F.array_compact(F.transform(F.map_keys(req), check)), F.lit(1))


def validate_requests(df: DataFrame, req_col: str, rules: dict, labels: dict) -> DataFrame:
    err = request_error(F.col(req_col), rules, labels)
    return df.withColumn("error", err).withColumn("valid", F.col("error").isNull())


def request_map(cols: list[str]) -> Column:
    """Build a request map<string,string> from columns (column order = key order)."""
    return F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("string"))])


# P7 ------------------------------------------------------------------------
def align_features(req: Column, features: list[str], numeric: list[str]) -> list[Column]:
    """Spec-ordered feature columns: absent -> 0, numeric -> try_cast double."""
    out = []
    for f in features:
        present = F.map_contains_key(req, f)
        v = req[f].try_cast("double") if f in numeric else req[f]
        default = F.lit(0.0) if f in numeric else F.lit("0")
        out.append(F.when(present, v).otherwise(default).alias(f))
    return out


def n_defaulted(req: Column, features: list[str]) -> Column:
    return sum((~F.map_contains_key(req, f)).cast("int") for f in features).alias("n_defaulted")


# Z1 ------------------------------------------------------------------------
def predict(model, df: DataFrame) -> DataFrame:
    """Class, probability vector as array, and confidence = max probability."""
    out = model.transform(df)
    if "probability" in out.columns:
        probs = vector_to_array("probability")
        return out.withColumn("probabilities", probs).withColumn("confidence", F.array_max(probs))
    if "rawPrediction" in out.columns:
        raw = vector_to_array("rawPrediction")
        return out.withColumn("confidence", E.logistic_confidence(raw[1] - raw[0]))
    return out.withColumn("confidence", F.lit(0.5))


# Z2 ------------------------------------------------------------------------
def confidence_band(conf: Column) -> Column:
    out = None
    for lo, level in RL.CONFIDENCE_BANDS:
        out = F.when(conf >= lo, F.lit(level)) if out is None else out.when(conf >= lo, F.lit(level))
    return F.when(conf.isNull(), F.lit("Unknown")).otherwise(out.otherwise(F.lit(RL.CONFIDENCE_FLOOR)))


def probability_difference(p1: Column) -> Column:
    return F.abs(p1 - (F.lit(1.0) - p1))


# Z3 ------------------------------------------------------------------------
def risk_category(pred: Column) -> Column:
    m = F.create_map(*[x for k, v in RL.RISK_CATEGORIES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[pred.cast("int")], F.lit(RL.RISK_CATEGORIES[0]))


def risk_description(pred: Column, conf: Column, rules: RL.RuleSet) -> Column:
    m = F.create_map(*[x for k, v in rules.descriptions.items() for x in (F.lit(k), F.lit(v))])
    base = F.coalesce(m[pred.cast("int")], F.lit(rules.descriptions[0]))
    return F.when(conf < RL.LOW_CONFIDENCE, F.concat(base, F.lit(RL.LOW_CONFIDENCE_NOTE))).otherwise(base)


# Z6 ------------------------------------------------------------------------
def explanation(pred: Column, conf: Column, rules: RL.RuleSet) -> Column:
    """Assessment, risk factors, protective factors and recommendations as text."""
    risk = RL.factors(rules.risk)
    prot = RL.factors(rules.protective)
    bullets = lambda a: F.transform(a, lambda x: F.concat(F.lit("• "), x))
    high = F.lit("\n".join(["\n**Immediate Recommendations:**"] + [f"• {r}" for r in rules.high_recs]))
    low = F.lit("\n".join(["\n**Preventive Recommendations:**"] + [f"• {r}" for r in rules.low_recs]))
    parts = F.concat(
        F.array(F.concat(F.lit("**Overall Assessment:** "), risk_description(pred, conf, rules))),
        F.when(F.size(risk) > 0, F.concat(F.array(F.lit("\n**Identified Risk Factors:**")), bullets(risk)))
         .otherwise(F.array().cast("array<string>")),
        F.when(F.size(prot) > 0, F.concat(F.array(F.lit("\n**Protective Factors:**")), bullets(prot)))
         .otherwise(F.array().cast("array<string>")),
        F.array(F.when(risk_category(pred) == RL.RISK_CATEGORIES[1], high).otherwise(low)))
    return F.array_join(parts, "\n")


# Z7 ------------------------------------------------------------------------
def population_stats(df: DataFrame, cols: list[str]) -> dict:
    """Mean and population std per column of the reference population (one aggregate)."""
    return {c: {"mean": m["mean"], "std": m["std_pop"]} for c, m in column_moments(df, cols).items()}


def population_percentiles(df: DataFrame, cols: list[str], stats: dict | None = None,
                           method: str = "normal") -> DataFrame:
    """Percentile of each value under N(mean, std) of the reference population
    (stats computed from ``df`` itself unless given)."""
    stats = stats or population_stats(df, cols)
    f = E.normal_percentile if method == "normal" else E.step_percentile
    return df.withColumns({f"{c}_pctl": f(F.col(c), F.lit(stats[c]["mean"]), F.lit(stats[c]["std"]))
                           for c in cols})


# Z8 ------------------------------------------------------------------------
def feature_impact(spark, names: list[str], importances: list[float], top: int = 8) -> DataFrame:
    """importance / max -> level (High > .7, Medium > .3, else Low); top-n by importance."""
    rows = [(n, float(v)) for n, v in zip(names, importances)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    mx = max([abs(v) for _, v in rows] or [0.0])
    norm = F.col("importance") / F.lit(mx) if mx > 0 else F.col("importance")
    lvl = None
    for lo, name in RL.IMPACT_LEVELS:
        lvl = F.when(norm > lo, F.lit(name)) if lvl is None else lvl.when(norm > lo, F.lit(name))
    return (df.select("feature", norm.alias("importance"), lvl.otherwise(F.lit(RL.IMPACT_FLOOR)).alias("impact_level"))
              .orderBy(F.desc("importance"), "feature").limit(top))


# Z9 ------------------------------------------------------------------------
HISTORY_SCHEMA = "timestamp timestamp, input_data map<string,string>, prediction int, confidence double"


def append_history(df: DataFrame, path: str, inputs: list[str], pred: str = "prediction",
                   conf: str = "confidence") -> None:
    """Append scored rows as history records (append-only parquet; no rewrite)."""
    df.select(F.current_timestamp().alias("timestamp"), request_map(inputs).alias("input_data"),
              F.col(pred).cast("int").alias("prediction"), F.col(conf).cast("double").alias("confidence")) \
      .write.mode("append").parquet(path)


def history_view(spark, path: str, n: int = 10) -> DataFrame:
    """Latest n records with display labels and 1-dp percentages."""
    h = spark.read.schema(HISTORY_SCHEMA).parquet(path)
    return recent(h, "timestamp", n).select(
        E.format_ts(F.col("timestamp")).alias("time"), risk_category(F.col("prediction")).alias("result"),
        F.format_string("%.1f%%", F.col("confidence") * 100).alias("confidence"), "input_data")



def recent(df: DataFrame, ts: str, n: int = 10, tiebreak: str | None = None) -> DataFrame:
    """Latest n rows (top-k: TakeOrderedAndProject, no full sort)."""
    order = [F.desc(ts)] + ([F.desc(tiebreak)] if tiebreak else [])
    return df.orderBy(*order).limit(n)

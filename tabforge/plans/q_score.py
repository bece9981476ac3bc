"""Request validation, interpretation and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import rules as RL
from ..operators import score as Z
from ..sources.tables import read_table
from .catalog import query
from .q_clean import cleaned_orderlines
from .q_profile import coerced
from .sqlparts import OL, OL_CLEAN_CHAIN, r6, with_

# ---------------------------------------------------------------------------
# Request rules and interpretation rules for order lines
# (same shape as the clinical presets in functions/rules.py).
# ---------------------------------------------------------------------------
ORDERLINE_REQUEST_RULES = {
    "l_quantity": ("range", 1, 45), "l_discount": ("range", 0, 0.1),
    "l_returnflag": ("options", ("A", "N", "R")), "l_linestatus": ("options", ("O",)),
}
ORDERLINE_LABELS = {"l_quantity": "Quantity", "l_discount": "Discount", "l_returnflag": "Return flag",
                    "l_linestatus": "Line status"}
ORDERLINE_RULES = RL.RuleSet(
    risk=(
        (("coalesce(l_discount, 0) > 0.08", "Deep discount (>8%)"),
         ("coalesce(l_discount, 0) > 0.05", "Elevated discount (>5%)")),
        (("coalesce(l_quantity, 0) > 40", "Large quantity (>40)"),),
        (("l_returnflag = 'R'", "Returned item"),),
        (("coalesce(l_tax, 0) > 0.06", "High tax (>6%)"),),
    ),
    protective=(
        (("l_linestatus = 'F'", "Line fulfilled"),),
        (("coalesce(l_discount, 0.05) <= 0.02", "Low discount"),),
    ),
    high_recs=("Prioritise fulfilment of the order", "Check stock for the line item"),
    low_recs=("No action needed",),
    descriptions={0: "The order line looks settled.", 1: "The order line looks still open."},
)
PRICE_SCALE = 105000.0


RULE_NUM = ("l_extendedprice", "l_discount", "l_quantity", "l_tax")
RULE_CAT = ("l_returnflag", "l_linestatus")


def _scored_lines(spark, sf_dir, numeric=("l_extendedprice",), categorical=()):
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=numeric, categorical=categorical)
    s = F.col("l_extendedprice") / F.lit(PRICE_SCALE)
    return cl.select("*", s.alias("s"), (s >= 0.5).cast("int").alias("pred"),
                     F.greatest(s, F.lit(1.0) - s).alias("confidence"))


SCORED_SQL = ("sl AS (SELECT *, l_extendedprice / CAST(105000 AS DOUBLE) AS s, "
              "CAST(l_extendedprice / CAST(105000 AS DOUBLE) >= 0.5 AS INTEGER) AS pred, "
              "greatest(l_extendedprice / CAST(105000 AS DOUBLE), 1 - l_extendedprice / CAST(105000 AS DOUBLE)) AS confidence "
              "FROM ol_clean)")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# P6 ------------------------------------------------------------------------
def _p6_sql_case() -> str:
    whens = []
    for c, rule in ORDERLINE_REQUEST_RULES.items():
        label = ORDERLINE_LABELS[c]
        if rule[0] == "range":
            whens.append(f"WHEN {c} IS NULL THEN {_q(label + ' must be a number')}")
            whens.append(f"WHEN {c} < {rule[1]} OR {c} > {rule[2]} THEN "
                         f"{_q(f'{label} must be between {rule[1]} and {rule[2]}')}")
        else:
            opts = ", ".join(_q(o) for o in rule[1])
            whens.append(f"WHEN {c} IS NULL OR {c} NOT IN ({opts}) THEN {_q('Invalid value for ' + label)}")
    return "CASE " + " ".join(whens) + " END"


@query("request_validation", with_(OL) +
       f"SELECT l_orderkey, l_linenumber, {_p6_sql_case()} AS error, ({_p6_sql_case()}) IS NULL AS valid FROM ol")
def q_request_validation(spark, sf_dir):
    df, _ = coerced(spark, sf_dir)
    req = Z.request_map(list(ORDERLINE_REQUEST_RULES))
    return Z.validate_requests(df.select("l_orderkey", "l_linenumber", req.alias("req")), "req",
                               ORDERLINE_REQUEST_RULES, ORDERLINE_LABELS).drop("req")


# P7 ------------------------------------------------------------------------
REQUEST_FEATURES = ["k", "value"]


@query("align_defaults", """SELECT event_id,
  CASE WHEN json_extract_string(props, '$.k') IS NOT NULL THEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) ELSE 0.0 END AS k,
  CASE WHEN json_extract_string(props, '$.value') IS NOT NULL THEN TRY_CAST(json_extract_string(props, '$.value') AS DOUBLE) ELSE 0.0 END AS value,
  CAST(json_extract_string(props, '$.k') IS NULL AS INTEGER) + CAST(json_extract_string(props, '$.value') IS NULL AS INTEGER) AS n_defaulted
FROM events""")
def q_align_defaults(spark, sf_dir):
    """Each event's JSON props is a scoring request; absent features default to 0."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "props"])
    req = F.from_json("props", "map<string,string>")
    return ev.select("event_id", *Z.align_features(req, REQUEST_FEATURES, REQUEST_FEATURES),
                     Z.n_defaulted(req, REQUEST_FEATURES))


# Z2 ------------------------------------------------------------------------
_BAND_SQL = "CASE " + " ".join(f"WHEN confidence >= {lo} THEN '{lv}'" for lo, lv in RL.CONFIDENCE_BANDS) + \
    f" ELSE '{RL.CONFIDENCE_FLOOR}' END"


@query("confidence_band", with_(*OL_CLEAN_CHAIN, SCORED_SQL) +
       f"SELECT l_orderkey, l_linenumber, {r6('confidence')} AS confidence, {_BAND_SQL} AS confidence_level, "
       f"{r6('abs(s - (1 - s))')} AS probability_difference FROM sl")
def q_confidence_band(spark, sf_dir):
    sc = _scored_lines(spark, sf_dir)
    return sc.select("l_orderkey", "l_linenumber", "confidence",
                     Z.confidence_band(F.col("confidence")).alias("confidence_level"),
                     Z.probability_difference(F.col("s")).alias("probability_difference"))


# Z3 ------------------------------------------------------------------------
def _desc_sql(rules) -> str:
    base = "CASE pred " + " ".join(f"WHEN {k} THEN {_q(v)}" for k, v in rules.descriptions.items()) + \
        f" ELSE {_q(rules.descriptions[0])} END"
    return f"CASE WHEN confidence < {RL.LOW_CONFIDENCE} THEN {base} || {_q(RL.LOW_CONFIDENCE_NOTE)} ELSE {base} END"


_CAT_SQL = "CASE pred " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in RL.RISK_CATEGORIES.items()) + \
    f" ELSE '{RL.RISK_CATEGORIES[0]}' END"


@query("risk_category", with_(*OL_CLEAN_CHAIN, SCORED_SQL) +
       f"SELECT l_orderkey, l_linenumber, pred, {_CAT_SQL} AS risk_category, {_desc_sql(ORDERLINE_RULES)} AS description FROM sl")
def q_risk_category(spark, sf_dir):
    sc = _scored_lines(spark, sf_dir)
    return sc.select("l_orderkey", "l_linenumber", "pred", Z.risk_category(F.col("pred")).alias("risk_category"),
                     Z.risk_description(F.col("pred"), F.col("confidence"), ORDERLINE_RULES).alias("description"))


# Z4 / Z5 -------------------------------------------------------------------
@query("risk_factors", with_(*OL_CLEAN_CHAIN) +
       f"SELECT l_orderkey, l_linenumber, {RL.factors_sql(ORDERLINE_RULES.risk)} AS risk_factors FROM ol_clean")
def q_risk_factors(spark, sf_dir):
    cl, _ = cleaned_orderlines(spark, sf_dir, numeric=RULE_NUM[1:], categorical=RULE_CAT[:1])
    return cl.select("l_orderkey", "l_linenumber",
                     F.array_join(RL.factors(ORDERLINE_RULES.risk), "; ").alias("risk_factors"))


@query("protective_factors", with_(*OL_CLEAN_CHAIN) +
       f"SELECT l_orderkey, l_linenumber, {RL.factors_sql(ORDERLINE_RULES.protective)} AS protective_factors FROM ol_clean")
def q_protective_factors(spark, sf_dir):
    cl, _ = cleaned_orderlines(spark, sf_dir, numeric=("l_discount",), categorical=("l_linestatus",))
    return cl.select("l_orderkey", "l_linenumber",
                     F.array_join(RL.factors(ORDERLINE_RULES.protective), "; ").alias("protective_factors"))


# Z6 ------------------------------------------------------------------------
def _explanation_sql(rules) -> str:
    def bullets(groups):
        out = []
        for group in groups:
            whens = " ".join(f"WHEN {c} THEN {_q('• ' + lab)}" for c, lab in group)
            out.append(f"CASE {whens} END")
        return out

    risk_any = f"{RL.factors_sql(rules.risk)} <> ''"
    prot_any = f"{RL.factors_sql(rules.protective)} <> ''"
    high = "\n".join(["\n**Immediate Recommendations:**"] + [f"• {r}" for r in rules.high_recs])
    low = "\n".join(["\n**Preventive Recommendations:**"] + [f"• {r}" for r in rules.low_recs])
    parts = ([f"'**Overall Assessment:** ' || ({_desc_sql(rules)})",
              f"CASE WHEN {risk_any} THEN {_q(chr(10) + '**Identified Risk Factors:**')} END"] +
             bullets(rules.risk) +
             [f"CASE WHEN {prot_any} THEN {_q(chr(10) + '**Protective Factors:**')} END"] +
             bullets(rules.protective) +
             [f"CASE WHEN pred = 1 THEN {_q(high)} ELSE {_q(low)} END"])
    return f"concat_ws(chr(10), {', '.join(parts)})"


@query("explanation", with_(*OL_CLEAN_CHAIN, SCORED_SQL) +
       f"SELECT l_orderkey, l_linenumber, {_explanation_sql(ORDERLINE_RULES)} AS explanation FROM sl")
def q_explanation(spark, sf_dir):
    sc = _scored_lines(spark, sf_dir, RULE_NUM, RULE_CAT)
    return sc.select("l_orderkey", "l_linenumber",
                     Z.explanation(F.col("pred"), F.col("confidence"), ORDERLINE_RULES).alias("explanation"))


# Z7 / E5 -------------------------------------------------------------------
def _erf_sql(z: str) -> str:
    t = f"(1.0 / (1.0 + {E.AS_P} * abs({z})))"
    poly = "0.0"
    for a in reversed(E.AS_A):
        poly = f"(({poly} + {a}) * {t})"
    y = f"(1.0 - {poly} * exp(-abs({z}) * abs({z})))"
    return f"(CASE WHEN {z} < 0 THEN -{y} ELSE {y} END)"


def _pct_sql(c: str) -> str:
    z = f"(({c} - m_{c}) / (s_{c} * {2 ** 0.5!r}))"
    return f"greatest(0.0, least(100.0, 0.5 * (1.0 + {_erf_sql(z)}) * 100))"


def _step_sql(c: str) -> str:
    z = f"(CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0.0 END)"
    return "CASE " + " ".join(f"WHEN {z} <= {e} THEN {v}" for e, v in E.Z_STEPS) + f" ELSE {E.Z_TOP} END"


_PCT_COLS = ["l_quantity", "l_extendedprice"]


@query("norm_percentile", with_(*OL_CLEAN_CHAIN, "st AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _PCT_COLS) + " FROM ol_clean)") +
    "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"{r6(_pct_sql(c))} AS {c}_pctl, {r6(_step_sql(c))} AS {c}_step" for c in _PCT_COLS) +
    " FROM ol_clean CROSS JOIN st")
def q_norm_percentile(spark, sf_dir):
    cl, _ = cleaned_orderlines(spark, sf_dir, numeric=tuple(_PCT_COLS), categorical=())
    stats = Z.population_stats(cl, _PCT_COLS)
    out = [F.col("l_orderkey"), F.col("l_linenumber")]
    for c in _PCT_COLS:
        m, s = F.lit(stats[c]["mean"]), F.lit(stats[c]["std"])
        out += [E.normal_percentile(F.col(c), m, s).alias(f"{c}_pctl"),
                E.step_percentile(F.col(c), m, s).alias(f"{c}_step")]
    return cl.select(*out)


# Z9 / W3 -------------------------------------------------------------------
HISTORY_N = 10


@query("history_recent", f"""SELECT event_id, ts, user_id, event_type, {r6('value')} AS value,
  strftime(ts, '%Y-%m-%d %H:%M') AS ts_text FROM events ORDER BY ts DESC, event_id DESC LIMIT {HISTORY_N}""")
def q_history_recent(spark, sf_dir):
    """Latest N records of the event history (top-k is the feature)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return Z.recent(ev, "ts", HISTORY_N, tiebreak="event_id").withColumn("ts_text", E.format_ts(F.col("ts")))


# E1-E4 ---------------------------------------------------------------------
@query("string_fns", """SELECT p_partkey,
  coalesce(p_retailprice / nullif(CAST(p_size - 25 AS DOUBLE), 0), 0.0) AS price_per_size,
  CASE WHEN length(p_name) <= 20 THEN p_name ELSE substr(p_name, 1, 17) || '...' END AS short_name,
  array_to_string(list_transform(string_split(lower(replace(p_type, '_', ' ')), ' '),
                  lambda x: upper(left(x, 1)) || substr(x, 2)), ' ') AS type_title,
  printf('%.1f%%', p_size / 50.0 * 100) AS size_pct
FROM part""")
def q_string_fns(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice"])
    return p.select("p_partkey",
                    E.safe_divide(F.col("p_retailprice"), F.col("p_size") - 25).alias("price_per_size"),
                    E.truncate_string("p_name", 20).alias("short_name"),
                    E.title_name("p_type").alias("type_title"),
                    E.format_percentage(F.col("p_size") / F.lit(50.0), 1).alias("size_pct"))


# E6-E8 ---------------------------------------------------------------------
@query("order_labels", f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS order_time,
  concat_ws('_', o_orderstatus, o_orderpriority) AS status_priority,
  {r6('1.0 / (1.0 + exp(-abs((o_totalprice - 250000) / 100000)))')} AS confidence
FROM orders""")
def q_order_labels(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority",
                                             "o_totalprice"])
    return o.select("o_orderkey", E.format_ts(F.col("o_orderdate")).alias("order_time"),
                    E.group_key("o_orderstatus", "o_orderpriority").alias("status_priority"),
                    E.logistic_confidence((F.col("o_totalprice") - 250000) / 100000).alias("confidence"))

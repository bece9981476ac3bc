"""Univariate feature-score queries (F3-F6) on the cleaned orderlines / users tables."""

from __future__ import annotations

from ..operators import stats as ST
from ..sources.tables import USERS, users
from .catalog import query
from .q_clean import OL_NUM, cleaned_orderlines
from .sqlparts import OL_CLEAN_CHAIN, USERS as USERS_CTE, r6, union_all, with_

K_SELECT = 2
USER_NUM = list(USERS.numeric)
MI_DISCRETE = ("l_linenumber", "l_returnflag")   # discrete features of the MI score


def _long(src: str, cols: list[str], y: str, expr: str = "{c}") -> str:
    return union_all(f"SELECT '{c}' AS feature, {y} AS y, CAST({expr.format(c=c)} AS DOUBLE) AS v FROM {src}"
                     for c in cols)


def _ranked(src: str, extra: str = "") -> str:
    return (f"SELECT feature, {r6('score')} AS score{extra}, "
            f"(row_number() OVER (ORDER BY score DESC, feature)) <= {K_SELECT} AS selected, "
            f"CAST(row_number() OVER (ORDER BY score DESC, feature) AS INTEGER) AS rank FROM {src}")


ANOVA_SQL = with_(*OL_CLEAN_CHAIN,
                  f"lg AS ({_long('ol_clean', OL_NUM, 'severity')})",
                  "g AS (SELECT feature, y, count(v) AS cnt, avg(v) AS m, coalesce(var_samp(v), 0) AS vr "
                  "FROM lg WHERE v IS NOT NULL GROUP BY feature, y)",
                  "h AS (SELECT *, sum(cnt) OVER (PARTITION BY feature) AS tot, "
                  "sum(cnt * m) OVER (PARTITION BY feature) / sum(cnt) OVER (PARTITION BY feature) AS gm FROM g)",
                  "s AS (SELECT feature, (sum(cnt * (m - gm) * (m - gm)) / (count(*) - 1)) / "
                  "(sum((cnt - 1) * vr) / (max(tot) - count(*))) AS score FROM h GROUP BY feature)") + _ranked("s")


@query("anova_f", ANOVA_SQL)
def q_anova_f(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=MI_DISCRETE)
    return ST.anova_f(cl, OL_NUM, spec.target, k=K_SELECT)


@query("anova_pvalues", rounded=False)
def q_anova_pvalues(spark, sf_dir):
    """F5 with p-values (regularized incomplete beta on the per-feature rows)."""
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=MI_DISCRETE)
    return ST.anova_f(cl, OL_NUM, spec.target, k=K_SELECT, p_values=True)


_ZST = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in OL_NUM)
_ZCOLS = ", ".join(f"({c} - m_{c}) / (CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END) AS {c}" for c in OL_NUM)
CHI2_SQL = with_(*OL_CLEAN_CHAIN,
                 f"st AS (SELECT {_ZST} FROM ol_clean)",
                 f"z AS (SELECT severity, {_ZCOLS} FROM ol_clean CROSS JOIN st)",
                 f"lg AS ({_long('z', OL_NUM, 'severity')})",
                 "g AS (SELECT feature, y, sum(v) AS sz, count(v) AS cnt, min(v) AS mn FROM lg GROUP BY feature, y)",
                 "o AS (SELECT *, sz - cnt * (min(mn) OVER () - 1e-8) AS ob FROM g)",
                 "e AS (SELECT *, sum(ob) OVER (PARTITION BY feature) * cnt / sum(cnt) OVER (PARTITION BY feature) AS ex FROM o)",
                 "s AS (SELECT feature, sum((ob - ex) * (ob - ex) / ex) AS score FROM e GROUP BY feature)") + _ranked("s")


@query("chi2_scores", CHI2_SQL)
def q_chi2_scores(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=MI_DISCRETE)
    return ST.chi2_scores(cl, OL_NUM, spec.target, k=K_SELECT)


@query("chi2_pvalues", rounded=False)
def q_chi2_pvalues(spark, sf_dir):
    """F3 with p-values (regularized upper incomplete gamma)."""
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=MI_DISCRETE)
    return ST.chi2_scores(cl, OL_NUM, spec.target, k=K_SELECT, p_values=True)


_CUTS = ", ".join(f"quantile_cont({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q_{c}" for c in OL_NUM)


def _bin(c: str) -> str:
    return "CAST(" + " + ".join(f"CAST({c} > q_{c}[{i}] AS INTEGER)" for i in range(1, 10)) + " AS VARCHAR)"


MI_SQL = with_(*OL_CLEAN_CHAIN,
               f"cuts AS (SELECT {_CUTS} FROM ol_clean)",
               "b AS (" + union_all(
                   [f"SELECT '{c}' AS feature, {_bin(c)} AS bin, severity AS y FROM ol_clean CROSS JOIN cuts"
                    for c in OL_NUM] +
                   ["SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), severity FROM ol_clean",
                    "SELECT 'l_returnflag', l_returnflag, severity FROM ol_clean"]) + ")",
               "n AS (SELECT feature, bin, y, CAST(count(*) AS DOUBLE) AS n FROM b WHERE bin IS NOT NULL GROUP BY feature, bin, y)",
               "w AS (SELECT *, sum(n) OVER (PARTITION BY feature, bin) AS px, sum(n) OVER (PARTITION BY feature, y) AS py, "
               "sum(n) OVER (PARTITION BY feature) AS tot FROM n)",
               "s AS (SELECT feature, sum(n / tot * ln(n * tot / (px * py))) AS score FROM w GROUP BY feature)") + _ranked("s")


@query("mutual_info", MI_SQL)
def q_mutual_info(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=MI_DISCRETE)
    return ST.mutual_info(cl, OL_NUM, ["l_linenumber", "l_returnflag"], spec.target, k=K_SELECT)


def _psi(x: str) -> str:
    """SQL of :func:`exprs.digamma`."""
    y = f"({x} + 10.0)"
    steps = " + ".join(f"1.0 / ({x} + {i}.0)" for i in range(10))
    i2 = f"(1.0 / ({y} * {y}))"
    return (f"(ln({y}) - 0.5 / {y} - {i2} * ({1 / 12!r} - {i2} * ({1 / 120!r} - {i2} * ({1 / 252!r} - {i2} * {1 / 240!r}))) - ({steps}))")


_KNN = 3
_KNN_VALUES = union_all(
    f"""SELECT '{c}' AS feature, severity AS cls,
  CAST(floor((CAST({c} AS DOUBLE) - st.lo_{c}) * st.scale_{c}) AS BIGINT)
  + CAST(('0x' || substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), '42/{c}')), 1, 8)) AS BIGINT) % {1 << 18} AS x
  FROM ol_clean CROSS JOIN st""" for c in OL_NUM)
_KNN_STATS = ", ".join(f"min(CAST({c} AS DOUBLE)) AS lo_{c}, pow(2.0, {45} - floor(log2(stddev_pop(CAST({c} AS DOUBLE))))) AS scale_{c}" for c in OL_NUM)
_KNN_R = "CASE " + " ".join(
    f"WHEN size - 1 {'>=' if k == _KNN else '='} {k} THEN least({', '.join(f'greatest(l{j}, r{k - j})' for j in range(k + 1))})" for k in range(1, _KNN + 1)) + " END"
MI_KNN_SQL = with_(
    *OL_CLEAN_CHAIN, f"st AS (SELECT {_KNN_STATS} FROM ol_clean)", f"vals AS ({_KNN_VALUES})",
    "sized AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY feature, cls) AS size FROM vals) WHERE size > 1)",
    "near AS (SELECT *, 0 AS l0, 0 AS r0, " + ", ".join(
        f"coalesce(x - lag(x, {j}) OVER w, {1 << 62}) AS l{j}, coalesce(lead(x, {j}) OVER w - x, {1 << 62}) AS r{j}" for j in range(1, _KNN + 1))
    + " FROM sized WINDOW w AS (PARTITION BY feature, cls ORDER BY x))",
    f"radius AS (SELECT feature, cls, size, x, greatest({_KNN_R} - 1, 0) AS r FROM near)",
    "m AS (SELECT feature, size, count(*) OVER (PARTITION BY feature ORDER BY x RANGE BETWEEN r PRECEDING AND r FOLLOWING) AS m FROM radius)",
    f"s AS (SELECT feature, greatest({_psi('CAST(count(*) AS DOUBLE)')} + avg({_psi(f'least({_KNN}, size - 1)')} - {_psi('size')} - {_psi('m')}), 0.0) AS score FROM m GROUP BY feature)") + _ranked("s")


@query("mutual_info_knn", MI_KNN_SQL)
def q_mutual_info_knn(spark, sf_dir):
    """the nearest-neighbour estimate for the continuous features."""
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=[])
    return ST.mutual_info_knn(cl, OL_NUM, spec.target, list(spec.key), k=K_SELECT)


CORR_THRESHOLD = 0.8
_PAIRS = union_all(f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS ar FROM users"
                   for i, a in enumerate(USER_NUM) for b in USER_NUM[i + 1:])
_VARS = union_all(f"SELECT '{c}' AS feature, var_samp({c}) AS var FROM users" for c in USER_NUM)
CORR_FILTER_SQL = with_(USERS_CTE, f"p AS ({_PAIRS})", f"vv AS ({_VARS})",
                        f"rm AS (SELECT DISTINCT CASE WHEN va.var < vb.var THEN p.a ELSE p.b END AS feature FROM p "
                        f"JOIN vv va ON p.a = va.feature JOIN vv vb ON p.b = vb.feature WHERE p.ar > {CORR_THRESHOLD})",
                        "mx AS (SELECT feature, max(ar) AS mc FROM (SELECT a AS feature, ar FROM p UNION ALL "
                        "SELECT b, ar FROM p) GROUP BY feature)") + \
    f"""SELECT vv.feature, rm.feature IS NOT NULL AS removed, {r6('mx.mc')} AS max_correlation
FROM vv LEFT JOIN mx ON vv.feature = mx.feature LEFT JOIN rm ON vv.feature = rm.feature"""


@query("corr_filter", CORR_FILTER_SQL)
def q_corr_filter(spark, sf_dir):
    df, spec = users(spark, sf_dir)
    return ST.corr_filter(df, USER_NUM, threshold=CORR_THRESHOLD)



# Votes across the three univariate selectors -------------------
VOTES_BASE = with_(
    f"anova AS ({ANOVA_SQL})", f"chi AS ({CHI2_SQL})", f"mi AS ({MI_SQL})",
    "sel AS (SELECT 'univariate' AS method, feature FROM anova WHERE selected UNION ALL "
    "SELECT 'chi_square', feature FROM chi WHERE selected UNION ALL "
    "SELECT 'mutual_information', feature FROM mi WHERE selected)",
    "fr AS (SELECT feature, count(*) AS votes FROM sel GROUP BY feature)",
    "rk AS (SELECT feature, votes, CAST(row_number() OVER (ORDER BY votes DESC, feature) AS INTEGER) AS rank FROM fr)")


def selections(spark, sf_dir):
    """(method, feature) for the top-K features of each univariate selector."""
    from pyspark.sql import functions as F
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=MI_DISCRETE, keyed=False)
    runs = {"univariate": ST.anova_f(cl, OL_NUM, spec.target, k=K_SELECT),
            "chi_square": ST.chi2_scores(cl, OL_NUM, spec.target, k=K_SELECT),
            "mutual_information": ST.mutual_info(cl, OL_NUM, ["l_linenumber", "l_returnflag"], spec.target,
                                                 k=K_SELECT)}
    out = None
    for m, t in runs.items():
        s = t.filter("selected").select(F.lit(m).alias("method"), "feature")
        out = s if out is None else out.unionByName(s)
    return out


@query("vote_ensemble", VOTES_BASE + "SELECT feature, votes, rank FROM rk "
       "WHERE votes >= 2 OR ((SELECT max(votes) FROM rk) < 2 AND rank <= 8)")
def q_vote_ensemble(spark, sf_dir):
    from ..operators import select as SEL
    return SEL.vote_ensemble(selections(spark, sf_dir))


@query("vote_intersection", VOTES_BASE + "SELECT feature FROM rk WHERE votes = (SELECT count(DISTINCT method) FROM sel)")
def q_vote_intersection(spark, sf_dir):
    from ..operators import select as SEL
    return SEL.vote_intersection(selections(spark, sf_dir))


@query("vote_union", VOTES_BASE + "SELECT feature, votes, rank FROM rk")
def q_vote_union(spark, sf_dir):
    from ..operators import select as SEL
    return SEL.vote_union(selections(spark, sf_dir))

"""Group risk tables, cross-tabs, histograms, box plots, KPIs."""

from __future__ import annotations

from ..operators import aggregate as G
from .catalog import query
from .q_clean import OL_NUM, capped_orderlines, cleaned_orderlines
from .q_profile import coerced
from ..sources.tables import customers
from .sqlparts import CUST, OL, OL_CAP_CHAIN, OL_CLEAN_CHAIN, r6, union_all, with_

# Display labels of the return-flag codes.
RETURNFLAG_LABELS = {"A": "accepted", "N": "none", "R": "returned"}
HIST_BINS = 30
GROUP_BINS = 20
PAIR_BINS = 10


@query("risk_by_code", with_(*OL_CAP_CHAIN) + f"""SELECT CAST(l_returnflag AS VARCHAR) AS code,
  CASE l_returnflag {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in RETURNFLAG_LABELS.items())} END AS label,
  count(*) AS total, CAST(sum(severity) AS BIGINT) AS positives, {r6('avg(CAST(severity AS DOUBLE)) * 100')} AS risk_rate
FROM ol_cap GROUP BY l_returnflag""")
def q_risk_by_code(spark, sf_dir):
    capped, spec = capped_orderlines(spark, sf_dir, numeric=(), categorical=("l_returnflag",))
    return G.risk_by_code(capped, "l_returnflag", spec.target, RETURNFLAG_LABELS)


_CT_FEATS = ["l_returnflag", "l_linestatus", "l_linenumber"]
_CT = "ct AS (" + union_all(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, severity AS by_value, count(*) AS cnt "
    f"FROM ol_clean GROUP BY {c}, severity" for c in _CT_FEATS) + ")"


@query("crosstab_norm", with_(*OL_CLEAN_CHAIN, _CT) +
       f"SELECT feature, value, by_value, cnt, {r6('cnt / sum(cnt) OVER (PARTITION BY feature, value)')} AS share FROM ct")
def q_crosstab_norm(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=(), categorical=_CT_FEATS)
    return G.crosstab(cl, _CT_FEATS, spec.target, normalize=True)


@query("crosstab", with_(*OL_CLEAN_CHAIN) +
       "SELECT 'l_returnflag' AS feature, l_returnflag AS value, l_linestatus AS by_value, count(*) AS cnt "
       "FROM ol_clean GROUP BY l_returnflag, l_linestatus")
def q_crosstab(spark, sf_dir):
    cl, _ = cleaned_orderlines(spark, sf_dir, numeric=(), categorical=("l_returnflag", "l_linestatus"))
    return G.crosstab(cl, ["l_returnflag"], "l_linestatus")


def _hist_sql(src: str, cols: list[str], bins: int, group: str | None) -> str:
    mm = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in cols)
    grp = f"CAST({group} AS VARCHAR)" if group else "CAST(NULL AS VARCHAR)"
    parts = []
    for c in cols:
        w = f"(CASE WHEN hi_{c} > lo_{c} THEN (hi_{c} - lo_{c}) / {bins} ELSE 1.0 END)"
        b = f"CAST(least(floor(({c} - lo_{c}) / {w}), {bins - 1}) AS INTEGER)"
        parts.append(f"SELECT '{c}' AS column, {grp} AS grp, {b} AS bin, lo_{c} AS lo0, {w} AS w "
                     f"FROM {src} CROSS JOIN mm WHERE {c} IS NOT NULL")
    return (f"mm AS (SELECT {mm} FROM {src}), hb AS (" + union_all(parts) + ")\n" +
            f"SELECT hb.\"column\", grp, bin, {r6('lo0 + bin * w')} AS lo, {r6('lo0 + (bin + 1) * w')} AS hi, "
            "count(*) AS cnt FROM hb GROUP BY hb.\"column\", grp, bin, lo0, w")


@query("histogram", with_(*OL_CLEAN_CHAIN).rstrip() + ",\n" + _hist_sql("ol_clean", OL_NUM, HIST_BINS, None))
def q_histogram(spark, sf_dir):
    cl, _ = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=())
    return G.histogram(cl, OL_NUM, bins=HIST_BINS)


@query("histogram_by_target", with_(*OL_CLEAN_CHAIN).rstrip() + ",\n" +
       _hist_sql("ol_clean", OL_NUM, GROUP_BINS, "severity"))
def q_histogram_by_target(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=())
    return G.histogram(cl, OL_NUM, bins=GROUP_BINS, group=spec.target)


def _box_sql(src: str, cols: list[str], group: str) -> str:
    lg = union_all(f"SELECT '{c}' AS column, CAST({group} AS VARCHAR) AS grp, CAST({c} AS DOUBLE) AS v FROM {src} "
                   f"WHERE {c} IS NOT NULL" for c in cols)
    return (f"lg AS ({lg}), q AS (SELECT lg.\"column\", grp, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, "
            "quantile_cont(v, 0.75) AS q3 FROM lg GROUP BY lg.\"column\", grp)\n"
            f"SELECT q.\"column\", q.grp, {r6('q1')} AS q1, {r6('med')} AS median, {r6('q3')} AS q3, "
            f"{r6('min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1))')} AS whisker_lo, "
            f"{r6('max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1))')} AS whisker_hi, "
            "count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers "
            "FROM lg JOIN q ON lg.\"column\" = q.\"column\" AND lg.grp = q.grp GROUP BY q.\"column\", q.grp, q1, med, q3")


@query("boxplot", with_(*OL_CLEAN_CHAIN).rstrip() + ",\n" + _box_sql("ol_clean", OL_NUM, "severity"))
def q_boxplot(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=())
    return G.boxplot(cl, OL_NUM, group=spec.target)


@query("target_balance", with_(OL) + f"""SELECT severity AS target_value, count(*) AS cnt,
  {r6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM ol GROUP BY severity""")
def q_target_balance(spark, sf_dir):
    df, spec = coerced(spark, sf_dir)
    return G.target_balance(df, spec.target)


@query("dist_by_target", with_(*OL_CLEAN_CHAIN) + union_all(
    f"SELECT '{c}' AS column, CAST(severity AS VARCHAR) AS grp, count({c}) AS count, {r6(f'avg({c})')} AS mean, "
    f"{r6(f'stddev_samp({c})')} AS std, {r6(f'min({c})')} AS min, {r6(f'quantile_cont({c}, 0.25)')} AS q25, "
    f"{r6(f'quantile_cont({c}, 0.5)')} AS q50, {r6(f'quantile_cont({c}, 0.75)')} AS q75, {r6(f'max({c})')} AS max "
    f"FROM ol_clean GROUP BY severity" for c in OL_NUM))
def q_dist_by_target(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=())
    return G.describe(cl, OL_NUM, group=spec.target)


@query("segment_risk", with_(CUST) + f"""SELECT c_mktsegment AS code, n_name AS label, count(*) AS total,
  CAST(sum(in_debt) AS BIGINT) AS positives, {r6('avg(CAST(in_debt AS DOUBLE)) * 100')} AS risk_rate
FROM cust GROUP BY c_mktsegment, n_name""")
def q_segment_risk(spark, sf_dir):
    """G1 on customers ⋈ nation: share of indebted accounts per (segment, nation)."""
    from pyspark.sql import functions as F
    df, spec = customers(spark, sf_dir)
    return (df.groupBy(F.col("c_mktsegment").alias("code"), F.col("n_name").alias("label"))
              .agg(F.count(F.lit(1)).alias("total"), F.sum(F.col(spec.target).cast("bigint")).alias("positives"),
                   (F.avg(F.col(spec.target).cast("double")) * 100).alias("risk_rate")))


@query("class_balance",with_(*OL_CLEAN_CHAIN) + f"""SELECT count(*) FILTER (WHERE severity = 0) AS n_negative,
  count(*) FILTER (WHERE severity = 1) AS n_positive,
  {r6('CAST(count(*) FILTER (WHERE severity = 1) AS DOUBLE) / count(*) FILTER (WHERE severity = 0)')} AS balance_ratio
FROM ol_clean""")
def q_class_balance(spark, sf_dir):
    """M1: class counts and balance ratio n1 / n0 of the prepared table."""
    from pyspark.sql import functions as F
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=(), categorical=())
    t = F.col(spec.target)
    return cl.agg(F.count_if(t == 0).alias("n_negative"), F.count_if(t == 1).alias("n_positive")) \
        .withColumn("balance_ratio", F.col("n_positive").cast("double") / F.col("n_negative"))


@query("kpis",with_(*OL_CLEAN_CHAIN) + f"""SELECT count(*) AS rows, CAST(7 AS BIGINT) AS features,
  CAST(sum(severity) AS BIGINT) AS positives, {r6('avg(CAST(severity AS DOUBLE)) * 100')} AS positive_rate FROM ol_clean""")
def q_kpis(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=(), categorical=())
    return G.kpis(cl, spec)


def _pair_sql(src: str, cols: list[str], bins: int, target: str) -> str:
    mm = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in cols)

    def b(c):
        w = f"(CASE WHEN hi_{c} > lo_{c} THEN (hi_{c} - lo_{c}) / {bins} ELSE 1.0 END)"
        return f"CAST(least(floor(({c} - lo_{c}) / {w}), {bins - 1}) AS INTEGER)"

    parts = [f"SELECT '{a}' AS x_col, '{c}' AS y_col, {target} AS target_value, {b(a)} AS x_bin, {b(c)} AS y_bin "
             f"FROM {src} CROSS JOIN mm" for i, a in enumerate(cols) for c in cols[i + 1:]]
    return (f"mm AS (SELECT {mm} FROM {src}), pb AS (" + union_all(parts) + ")\n"
            "SELECT x_col, y_col, target_value, x_bin, y_bin, count(*) AS cnt FROM pb "
            "WHERE x_bin IS NOT NULL AND y_bin IS NOT NULL GROUP BY x_col, y_col, target_value, x_bin, y_bin")


@query("pair_bins", with_(*OL_CLEAN_CHAIN).rstrip() + ",\n" + _pair_sql("ol_clean", OL_NUM, PAIR_BINS, "severity"))
def q_pair_bins(spark, sf_dir):
    cl, spec = cleaned_orderlines(spark, sf_dir, numeric=OL_NUM, categorical=())
    return G.pair_bins(cl, OL_NUM, spec.target, bins=PAIR_BINS)

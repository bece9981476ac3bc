"""Group risk tables, cross-tabs, histograms and box-plot statistics.

All outputs are aggregates whose size is bounded by (#columns x #groups x
#bins); no row-level data reaches the driver.  Multi-column operators
unpivot (Expand) or explode a fixed-size array so that one scan and one
partially-aggregated shuffle serve every column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..spec import FeatureSpec
from .common import column_moments, long_values
from .quantiles import quantiles


# G2 ------------------------------------------------------------------------
def band_index(c, edges: list[float]) -> Column:
    """Left-closed bins [e_i, e_{i+1}); outside every bin -> NULL."""
    x = F.col(c) if isinstance(c, str) else c
    expr = None
    for i in range(len(edges) - 1):
        cond = (x >= F.lit(edges[i])) & (x < F.lit(edges[i + 1]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def band_dimension(spark, edges: list[float], labels: list[str]) -> DataFrame:
    rows = [(i, labels[i], float(edges[i]), float(edges[i + 1])) for i in range(len(edges) - 1)]
    return spark.createDataFrame(rows, "bin int, band string, lo double, hi double")


# G1 + G2 ---------------------------------------------------------------------
def risk_by_band(df: DataFrame, col: str, edges: list[float], labels: list[str],
                 target: str) -> DataFrame:
    """count / positives / rate*100 per band; every band emitted, empty ones with 0 and NULL rate;
    values outside all bands form a NULL band row when present."""
    agg = (df.groupBy(band_index(col, edges).alias("bin"))
             .agg(F.count(F.lit(1)).alias("total"),
                  F.sum(F.col(target).cast("bigint")).alias("positives"),
                  (F.avg(F.col(target).cast("double")) * 100).alias("risk_rate")))
    dim = band_dimension(df.sparkSession, edges, labels)
    # dim holds len(edges)-1 rows and agg at most one more: both tiny.
    return (dim.join(agg, "bin", "full")
               .select("bin", "band", "lo", "hi",
                       F.coalesce("total", F.lit(0).cast("bigint")).alias("total"),
                       F.coalesce("positives", F.lit(0).cast("bigint")).alias("positives"),
                       "risk_rate"))


# G1 + G3 ---------------------------------------------------------------------
def risk_by_code(df: DataFrame, col: str, target: str, code_labels: dict) -> DataFrame:
    m = F.create_map(*[x for k, v in code_labels.items() for x in (F.lit(k), F.lit(v))])
    return (df.groupBy(col)
              .agg(F.count(F.lit(1)).alias("total"),
                   F.sum(F.col(target).cast("bigint")).alias("positives"),
                   (F.avg(F.col(target).cast("double")) * 100).alias("risk_rate"))
              .select(F.col(col).cast("string").alias("code"), m[F.col(col)].alias("label"),
                      "total", "positives", "risk_rate"))


# G4 / G5 ---------------------------------------------------------------------
def crosstab(df: DataFrame, features: list[str], by: str, normalize: bool = False) -> DataFrame:
    """Long cross-tab (feature, value, by, cnt[, share]) for several features in one pass.
    ``share`` is row-normalised (per feature value), as a window over the tiny count table."""
    long = long_values(df, features, ids=[by], name="feature", value="value", cast="string")
    out = long.groupBy("feature", "value", F.col(by).alias("by_value")).agg(
        F.count(F.lit(1)).alias("cnt"))
    if normalize:
        w = Window.partitionBy("feature", "value")
        out = out.withColumn("share", F.col("cnt") / F.sum("cnt").over(w))
    return out


# G6 ------------------------------------------------------------------------
def histogram(df: DataFrame, cols: list[str], bins: int = 30, group: str | None = None,
              ranges: dict | None = None) -> DataFrame:
    """Equal-width bins over [min, max] per column (max falls in the last bin).

    Output (column, grp, bin, lo, hi, cnt); only non-empty bins.  Bin edges
    come from one min/max aggregate (bounded by #columns).
    """
    ranges = ranges or {c: (m["min"], m["max"]) for c, m in column_moments(df, cols).items()}
    parts = []
    for c in cols:
        lo, hi = ranges[c]
        if lo is None:
            continue
        w = (hi - lo) / bins if hi > lo else 1.0
        b = F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")
        parts.append(F.struct(F.lit(c).alias("column"), b.alias("bin"),
                              F.lit(float(lo)).alias("lo0"), F.lit(float(w)).alias("w")))
    g = F.col(group).cast("string") if group else F.lit(None).cast("string")
    ex = df.select(g.alias("grp"), F.explode(F.array(*parts)).alias("h")).filter("h.bin is not null")
    return (ex.groupBy("h.column", "grp", "h.bin", "h.lo0", "h.w").agg(F.count(F.lit(1)).alias("cnt"))
              .select("column", "grp", "bin",
                      (F.col("lo0") + F.col("bin") * F.col("w")).alias("lo"),
                      (F.col("lo0") + (F.col("bin") + 1) * F.col("w")).alias("hi"), "cnt"))


# G7 / G9 ---------------------------------------------------------------------
def _long_by_group(df: DataFrame, cols: list[str], group: str | None) -> DataFrame:
    grp = F.col(group).cast("string") if group else F.lit(None).cast("string")
    base = df.select(grp.alias("grp"), *[F.col(c).cast("double").alias(c) for c in cols])
    return base.unpivot(["grp"], cols, "column", "value")


def boxplot(df: DataFrame, cols: list[str], group: str | None = None, k: float = 1.5) -> DataFrame:
    """q1, median, q3, whiskers (furthest points within k*IQR), outlier count per (column, grp).

    Quartiles and whiskers both come from the table of distinct values, joined
    to its own quartiles; the data are read once to make it."""
    counts = (_long_by_group(df, cols, group).filter(F.col("value").isNotNull())
              .groupBy("column", "grp", "value").agg(F.count(F.lit(1)).alias("cnt")))
    q = quantiles(counts, ["column", "grp"], [0.25, 0.5, 0.75]).select(
        F.col("column").alias("q_column"), F.col("grp").alias("q_grp"), F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    on = (F.col("column") == F.col("q_column")) & F.col("grp").eqNullSafe(F.col("q_grp"))
    lo = F.col("q1") - F.lit(k) * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1"))
    v = F.col("value")
    return (counts.join(q, on).groupBy("column", "grp", "q1", "median", "q3")
            .agg(F.min(F.when(v >= lo, v)).alias("whisker_lo"), F.max(F.when(v <= hi, v)).alias("whisker_hi"),
                 F.coalesce(F.sum(F.when((v < lo) | (v > hi), F.col("cnt"))), F.lit(0)).cast("bigint").alias("n_outliers")))


def describe(df: DataFrame, cols: list[str], group: str | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, std (sample), min, 25/50/75 % (linear), max per (column[, grp]).
    ``exact=False`` takes the quartiles from the bounded-memory quantile sketch."""
    long = _long_by_group(df, cols, group)
    x = F.col("value")
    moments = [F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
               F.min(x).alias("min"), F.max(x).alias("max")]
    if exact:
        counts = long.groupBy("column", "grp", "value").agg(F.count(F.lit(1)).alias("cnt"))
        q = quantiles(counts, ["column", "grp"], [0.25, 0.5, 0.75]).select(
            F.col("column").alias("q_column"), F.col("grp").alias("q_grp"), "q")
        on = (F.col("column") == F.col("q_column")) & F.col("grp").eqNullSafe(F.col("q_grp"))
        out = long.groupBy("column", "grp").agg(*moments).join(q, on, "left")
    else:
        out = long.groupBy("column", "grp").agg(*moments, F.percentile_approx(x, [0.25, 0.5, 0.75], 10000).alias("q"))
    return out.select("column", *(["grp"] if group else []), "count", "mean", "std", "min", F.col("q")[0].alias("q25"),
                      F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max")


# G8 ------------------------------------------------------------------------
def target_balance(df: DataFrame, target: str) -> DataFrame:
    c = df.groupBy(F.col(target).alias("target_value")).agg(F.count(F.lit(1)).alias("cnt"))
    return c.withColumn("pct", F.col("cnt") * 100.0 / F.lit(df.count()))


# G10 -----------------------------------------------------------------------
def kpis(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    t = F.col(spec.target).cast("double")
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.lit(len(spec.features)).cast("bigint").alias("features"),
                  F.sum(F.col(spec.target).cast("bigint")).alias("positives"),
                  (F.avg(t) * 100).alias("positive_rate"))


# G11 -----------------------------------------------------------------------
def group_sizes(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("size"))


# G12 -----------------------------------------------------------------------
def pair_bins(df: DataFrame, cols: list[str], target: str, bins: int = 10,
              ranges: dict | None = None) -> DataFrame:
    """2-D binned counts for every numeric pair (i<j) x target: bounded scatter data."""
    ranges = ranges or {c: (m["min"], m["max"]) for c, m in column_moments(df, cols).items()}

    def b(c):
        lo, hi = ranges[c]
        w = (hi - lo) / bins if hi > lo else 1.0
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")

    pairs = [F.struct(F.lit(a).alias("x_col"), F.lit(c).alias("y_col"), b(a).alias("x_bin"),
                      b(c).alias("y_bin"))
             for i, a in enumerate(cols) for c in cols[i + 1:]]
    ex = df.select(F.col(target).alias("target_value"), F.explode(F.array(*pairs)).alias("p"))
    return (ex.filter("p.x_bin is not null and p.y_bin is not null")
              .groupBy("p.x_col", "p.y_col", "target_value", "p.x_bin", "p.y_bin")
              .agg(F.count(F.lit(1)).alias("cnt")))

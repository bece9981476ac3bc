"""Profiling and data-quality checks.

Each check is one pass over the data with all columns in a single
aggregate (or an unpivot + grouped aggregate), producing a small long-form
DataFrame ``(column, ...)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..spec import FeatureSpec
from .aggregate import describe
from .common import is_string, long_values
from .quantiles import quantiles, value_counts_of


def _stack(df_one_row: DataFrame, items: list[tuple[str, str]], value_name: str,
           value_type: str = "bigint") -> DataFrame:
    """Turn a one-row aggregate into (column, value) rows."""
    pairs = ", ".join(f"'{c}', cast(`{a}` as {value_type})" for c, a in items)
    return df_one_row.selectExpr(f"stack({len(items)}, {pairs}) as (column, {value_name})")


# D1 ------------------------------------------------------------------------
def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    return _stack(one, [(c, f"n{i}") for i, c in enumerate(cols)], "missing")


# D2 ------------------------------------------------------------------------
def sentinel_counts(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Raw sentinel tokens per column, before coercion."""
    items, aggs = [], []
    for i, c in enumerate([c for c in spec.features if c in df.columns]):
        toks = spec.tokens_for(c)
        if not toks:
            continue
        if is_string(df, c):
            cond = F.trim(F.col(c)).isin([str(t) for t in toks])
        else:
            cond = F.col(c).isin([t for t in toks if isinstance(t, (int, float))])
        aggs.append(F.count_if(cond).alias(f"s{i}"))
        items.append((c, f"s{i}"))
    if not items:
        return df.sparkSession.createDataFrame([], "column string, sentinels bigint")
    return _stack(df.agg(*aggs), items, "sentinels")


# D3 ------------------------------------------------------------------------
def range_violations(df: DataFrame, spec: FeatureSpec, sample: int = 10) -> DataFrame:
    """(column, lo, hi, violations, sample) for columns with a declared range.

    Counts come from one aggregate.  The sample is the first ``sample``
    violating values in key order; Spark limits each group before the exchange
    of that window, so only ``sample`` rows per column and task are shuffled.
    """
    cols = [c for c in spec.ranges if c in df.columns and c != spec.target]
    key = list(spec.key)
    bad = {c: (F.col(c) < F.lit(spec.ranges[c][0])) | (F.col(c) > F.lit(spec.ranges[c][1])) for c in cols}
    counts = _stack(df.agg(*[F.count_if(bad[c]).alias(f"v{i}") for i, c in enumerate(cols)]),
                    [(c, f"v{i}") for i, c in enumerate(cols)], "violations")
    viol = [F.when(bad[c], F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")))
            for c in cols]
    long = (df.select(*key, F.explode(F.array_compact(F.array(*viol))).alias("v"))
              .select(*key, "v.column", "v.value"))
    w = Window.partitionBy("column").orderBy(*key)
    firsts = (long.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= sample)
                   .groupBy("column")
                   .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", "value"))),
                                                 lambda s: F.format_string("%.2f", s["value"])), ",")
                        .alias("sample")))
    dims = df.sparkSession.createDataFrame(
        [(c, float(spec.ranges[c][0]), float(spec.ranges[c][1])) for c in cols],
        "column string, lo double, hi double")
    return (dims.join(counts, "column").join(firsts, "column", "left")
                .filter(F.col("violations") > 0))


# D4 ------------------------------------------------------------------------
def duplicate_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """rows - distinct rows (NULLs equal), one shuffle with map-side combine."""
    cols = cols or df.columns
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt"))
              .agg(F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")))


# D5 ------------------------------------------------------------------------
def validation_report(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Long report (check, column, value): missing and range counts from one
    pass, duplicates from one grouped pass, and the overall ``is_valid``
    (missing or range violations clear it; duplicates are reported only)."""
    cols = [c for c in spec.columns if c in df.columns]
    rcols = [c for c in spec.ranges if c in df.columns]
    aggs = [F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)]
    aggs += [F.count_if((F.col(c) < spec.ranges[c][0]) | (F.col(c) > spec.ranges[c][1])).alias(f"r{i}")
             for i, c in enumerate(rcols)]
    aggs.append(F.count(F.lit(1)).alias("rows"))
    one = df.agg(*aggs)
    items = [f"'missing', '{c}', cast(m{i} as bigint)" for i, c in enumerate(cols)]
    items += [f"'range', '{c}', cast(r{i} as bigint)" for i, c in enumerate(rcols)]
    items.append("'rows', cast(null as string), cast(rows as bigint)")
    bad = " + ".join([f"m{i}" for i in range(len(cols))] + [f"r{i}" for i in range(len(rcols))]) or "0"
    items.append(f"'is_valid', cast(null as string), cast(({bad}) = 0 as bigint)")
    rep = one.selectExpr(f"stack({len(items)}, {', '.join(items)}) as (check, column, value)")
    dups = duplicate_rows(df, [c for c in cols if c not in spec.key]).select(
        F.lit("duplicates").alias("check"), F.lit(None).cast("string").alias("column"),
        F.col("duplicate_rows").alias("value"))
    return rep.unionByName(dups)


# Texts of the validation issues.
MISSING_ISSUE = "Found %d missing values"
RANGE_ISSUE = "Column '%s' has %d values outside valid range [%s, %s]"
DUPLICATE_ISSUE = "Found %d duplicate rows"


def validation_issues(report: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(check, column, text): what :func:`validation_report` has found, in words."""
    bounds = spec.ranges
    lo, hi = (F.create_map(*[x for c, b in bounds.items() for x in (F.lit(c), F.lit(str(b[i])))]) for i in (0, 1))
    found = report.filter("value > 0")
    missing = (found.filter("check = 'missing'").agg(F.sum("value").alias("value")).filter("value > 0")
               .select(F.lit("missing").alias("check"), F.lit(None).cast("string").alias("column"),
                       F.format_string(MISSING_ISSUE, "value").alias("text")))
    ranges = found.filter("check = 'range'").select("check", "column", F.format_string(
        RANGE_ISSUE, "column", "value", lo[F.col("column")], hi[F.col("column")]).alias("text"))
    copies = found.filter("check = 'duplicates'").select("check", "column", F.format_string(DUPLICATE_ISSUE, "value").alias("text"))
    return missing.unionByName(ranges).unionByName(copies)


def dataset_statistics(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Long (section, column, name, value): describe() of the numeric columns,
    value counts of the categorical ones and the correlation of every pair."""
    from .stats import corr_matrix

    stats = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    items = ", ".join(f"'{s}', cast(`{s}` as double)" for s in stats)
    parts = [describe(df, numeric).selectExpr("'statistics' as section", "column", f"stack({len(stats)}, {items}) as (name, value)"),
             value_counts(df, categorical).selectExpr("'value_counts' as section", "column", "value as name", "cast(cnt as double) as value"),
             corr_matrix(df, numeric).selectExpr("'correlation' as section", "a as column", "b as name", "r as value")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# D7 / D10 ------------------------------------------------------------------
def _n_unique(x, exact: bool):
    # exact distinct counting shuffles every distinct (column, value); the HLL
    # sketch keeps a fixed-size register per column instead
    return F.count_distinct(x) if exact else F.approx_count_distinct(x, 0.01)


def feature_summary(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """dtype, non-null, null, n_unique (NULLs excluded), min/max/mean/std/median.
    ``exact=False``: HLL distinct counts and the quantile sketch for the median."""
    dtypes = dict(df.dtypes)
    long = long_values(df, cols)
    x = F.col("value")
    moments = [F.count(x).alias("non_null"), F.count_if(x.isNull()).alias("nulls"), F.min(x).alias("min"),
               F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std")]
    if exact:
        # distinct counts and medians both come from the table of counts
        counts = value_counts_of(df, cols)
        stats = (long.groupBy("column").agg(*moments)
                 .join(counts.groupBy("column").agg(F.count("value").alias("n_unique")), "column")
                 .join(quantiles(counts, ["column"], [0.5]).select("column", F.col("q")[0].alias("median")), "column", "left"))
    else:
        stats = long.groupBy("column").agg(*moments, _n_unique(x, False).alias("n_unique"),
                                           F.percentile_approx(x, 0.5, 10000).cast("double").alias("median"))
    stats = stats.select("column", "non_null", "nulls", "n_unique", "min", "max", "mean", "std", "median")
    types = df.sparkSession.createDataFrame([(c, dtypes[c]) for c in cols], "column string, dtype string")
    return types.join(stats, "column")


def column_types(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """(column, dtype, non_null, n_unique) for every column (any type)."""
    cols = cols or df.columns
    dtypes = dict(df.dtypes)
    long = long_values(df, cols, cast="string")
    x = F.col("value")
    stats = long.groupBy("column").agg(F.count(x).alias("non_null"), _n_unique(x, exact).alias("n_unique"))
    types = df.sparkSession.createDataFrame([(c, dtypes[c]) for c in cols], "column string, dtype string")
    return types.join(stats, "column")


# D8 ------------------------------------------------------------------------
def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, cnt, share) for low-cardinality columns, NULLs excluded."""
    long = long_values(df, cols, cast="string").filter(F.col("value").isNotNull())
    c = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    # per-column totals (one row per column) joined back -- not a window per
    # column, which would put a high-cardinality column's values in one task
    tot = c.groupBy("column").agg(F.sum("cnt").alias("_tot"))
    return c.join(F.broadcast(tot), "column").select(
        "column", "value", "cnt", (F.col("cnt") / F.col("_tot")).alias("share"))


# D9 ------------------------------------------------------------------------
def dataset_info(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Long (metric, value): rows, columns, numeric/categorical counts, missing cells, duplicate rows."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("rows"),
                 sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0)).alias("missing"))
    n_cat = len([c for c in spec.categorical if c not in spec.numeric])
    shape = one.selectExpr(
        f"stack(5, 'rows', cast(rows as bigint), 'columns', cast({len(cols)} as bigint), "
        f"'numeric', cast({len(spec.numeric)} as bigint), 'categorical', cast({n_cat} as bigint), "
        f"'missing', cast(missing as bigint)) as (metric, value)")
    dups = duplicate_rows(df, [c for c in cols if c not in spec.key]).select(
        F.lit("duplicate_rows").alias("metric"), F.col("duplicate_rows").alias("value"))
    return shape.unionByName(dups)


# D11 -----------------------------------------------------------------------
def compare_describe(before: DataFrame, after: DataFrame, cols: list[str]) -> DataFrame:
    """Describe both tables and join on column: (column, stat, before, after, delta)."""
    stats = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]

    def longer(d, name):
        items = ", ".join(f"'{s}', cast(`{s}` as double)" for s in stats)
        return d.selectExpr("column", f"stack({len(stats)}, {items}) as (stat, {name})")

    b = longer(describe(before, cols), "before")
    a = longer(describe(after, cols), "after")
    return b.join(a, ["column", "stat"]).withColumn("delta", F.col("after") - F.col("before"))

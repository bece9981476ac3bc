"""Cleaning, imputation, encoding, scaling and outlier capping.

Each fit step is one distributed aggregate whose result is bounded by the
number of columns; each apply step is a lazy projection that stays inside
whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from ..spec import FeatureSpec
from .common import column_moments, column_quantiles, is_numeric, is_string
from .quantiles import modes as modes_of, value_counts_of
from .ranks import range_parted, running_count


# T1 ------------------------------------------------------------------------
def sentinel_to_null(df: DataFrame, spec: FeatureSpec, c: str) -> Column:
    x = F.col(c)
    tokens = spec.tokens_for(c)
    if is_string(df, c):
        x = F.trim(x)
        str_tokens = [str(t) for t in tokens]
        if str_tokens:
            x = F.when(x.isin(str_tokens), F.lit(None)).otherwise(x)
    else:
        num_tokens = [t for t in tokens if isinstance(t, (int, float))]
        if num_tokens:
            x = F.when(x.isin(num_tokens), F.lit(None)).otherwise(x)
    return x


def coerce_numeric(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Sentinel tokens -> NULL; numeric features -> double (unparseable -> NULL, NaN -> NULL).

    Categorical columns keep their type (string categories stay strings);
    key columns are never touched.
    """
    out = []
    for f in df.schema.fields:
        c = f.name
        if c in spec.features and c not in spec.key:
            x = sentinel_to_null(df, spec, c)
            if c in spec.numeric or (spec.numeric_codes and c in spec.categorical):
                x = x.try_cast("double") if is_string(df, c) else x.cast("double")
                x = F.when(F.isnan(x), F.lit(None)).otherwise(x)
            out.append(x.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# T2 ------------------------------------------------------------------------
def fit_medians(df: DataFrame, cols: list[str], exact: bool = True) -> dict:
    q = column_quantiles(df, cols, [0.5], exact=exact)
    return {c: v[0] for c, v in q.items() if v[0] is not None}


def impute_median(df: DataFrame, spec: FeatureSpec, exact: bool = True,
                  medians: dict | None = None) -> DataFrame:
    cols = [c for c in spec.numeric if c in df.columns]
    medians = fit_medians(df, cols, exact) if medians is None else medians
    return df.fillna({c: float(v) for c, v in medians.items()}) if medians else df


# T3 ------------------------------------------------------------------------
def _by_type(df: DataFrame, cols: list[str]) -> list[tuple[list[str], str]]:
    """Columns that can share one table of counts, and its value type."""
    text = [c for c in cols if is_string(df, c)]
    other = [c for c in cols if c not in text]
    return [(cs, t) for cs, t in ((other, "double"), (text, "string")) if cs]


def _as_stored(df: DataFrame, c: str, v):
    """A counted value in the column's own type."""
    return int(v) if isinstance(df.schema[c].dataType, T.IntegralType) else v


def fit_modes(df: DataFrame, cols: list[str]) -> dict:
    """Most frequent value per column; ties -> smallest; all-NULL -> 0."""
    out = {c: (0 if is_numeric(df, c) else "0") for c in cols}
    for cs, kind in _by_type(df, cols):
        for r in modes_of(value_counts_of(df, cs, cast=kind), ["column"]).collect():      # one row per column
            if r["mode"] is not None:
                out[r["column"]] = _as_stored(df, r["column"], r["mode"])
    return out


def impute_mode(df: DataFrame, spec: FeatureSpec, modes: dict | None = None) -> DataFrame:
    cols = [c for c in spec.categorical if c in df.columns and c not in spec.numeric]
    modes = fit_modes(df, cols) if modes is None else modes
    return df.fillna(modes) if modes else df


# T4 ------------------------------------------------------------------------
def binarize_target(df: DataFrame, spec: FeatureSpec, threshold: float = 0) -> DataFrame:
    """target > threshold -> 1 else 0; rows with a NULL target are dropped (they cannot be labelled)."""
    t = spec.target
    if not t or t not in df.columns:
        return df
    return df.filter(F.col(t).isNotNull()).withColumn(t, (F.col(t) > threshold).cast("int"))


# T5 ------------------------------------------------------------------------
def fit_fill_values(df: DataFrame, spec: FeatureSpec, exact: bool = True) -> tuple[dict, dict]:
    """Medians of the numeric columns and modes of the categorical ones."""
    num = [c for c in spec.numeric if c in df.columns]
    cat = [c for c in spec.categorical if c in df.columns and c not in spec.numeric]
    return fit_medians(df, num, exact), fit_modes(df, cat)


def clean_with_levels(df: DataFrame, spec: FeatureSpec, exact: bool = True) -> tuple[DataFrame, dict]:
    """T5 + the T6 encoding levels.

    Imputation never adds a level (the mode is an observed value), so the
    sorted distinct values of the labelled rows before imputation are the
    levels of the cleaned table; an all-NULL column gets its fill value."""
    out = materialize(coerce_numeric(df, spec), "coerced")      # the input's joins run once
    med, modes = fit_fill_values(out, spec, exact)
    labelled = out.filter(F.col(spec.target).isNotNull()) if spec.target in out.columns else out
    info = {c: (kind, vals or [modes.get(c, 0)]) for c, (kind, vals) in fit_encoding(labelled, spec).items()}
    cleaned = binarize_target(impute_mode(impute_median(out, spec, medians=med), spec, modes=modes), spec)
    return cleaned, info


def clean(df: DataFrame, spec: FeatureSpec, exact: bool = True, binarize: bool = True) -> DataFrame:
    """T1 -> T2 -> T3 -> T4.  The coerced table is written once; the fits and the
    lazy projection of the result read it."""
    return clean_with_fills(df, spec, exact, binarize)[0]


def clean_with_fills(df: DataFrame, spec: FeatureSpec, exact: bool = True, binarize: bool = True) -> tuple[DataFrame, dict, dict]:
    """:func:`clean`, and the medians and modes it filled in."""
    out = materialize(coerce_numeric(df, spec), "coerced")
    med, modes = fit_fill_values(out, spec, exact)
    out = impute_median(out, spec, medians=med)
    out = impute_mode(out, spec, modes=modes)
    return binarize_target(out, spec) if binarize else out, med, modes


# T6 ------------------------------------------------------------------------
#: A column with more levels is encoded by a join with a table of its levels.
MAX_LITERAL_LEVELS = 1000


@dataclass
class LevelTable:
    """The levels of a column with very many: a written table (value, idx)."""

    table: DataFrame
    n: int


def fit_encoding(df: DataFrame, spec: FeatureSpec) -> dict:
    """Sorted distinct values per categorical column: {col: (kind, [values])}.

    The distinct (column, value) pairs are a written table.  Columns of up to
    ``MAX_LITERAL_LEVELS`` of them bring their levels to the driver; a larger
    one has a :class:`LevelTable` in place of the list."""
    cats = [c for c in spec.categorical if c in df.columns]
    levels: dict = {c: [] for c in cats}
    for cs, kind in _by_type(df, cats):
        found = materialize(value_counts_of(df, cs, cast=kind).filter(F.col("value").isNotNull()).select("column", "value"), "levels")
        sizes = {r["column"]: r["count"] for r in found.groupBy("column").count().collect()}       # one row a column
        few = [c for c, n in sizes.items() if n <= MAX_LITERAL_LEVELS]
        for r in found.filter(F.col("column").isin(few)).collect():
            levels[r["column"]].append(_as_stored(df, r["column"], r["value"]))
        for c in sizes.keys() - set(few):
            own = range_parted(found.filter(F.col("column") == c), ["column"], ["value"], "sorted-levels")
            ranked = running_count(own, ["column"], ["value"], F.lit(1), "n")
            levels[c] = LevelTable(materialize(ranked.select("value", (F.col("n") - 1).cast("int").alias("idx")), "level-ranks"), sizes[c])
    return {c: ("binary" if c in spec.binary else "ordinal" if c in spec.ordinal else "categorical",
                v if isinstance(v, LevelTable) else sorted(v)) for c, v in levels.items()}


def encode(df: DataFrame, spec: FeatureSpec, info: dict | None = None) -> tuple[DataFrame, dict]:
    """Numeric-coded categoricals -> int; string categoricals -> 0-based index in sorted order."""
    info = fit_encoding(df, spec) if info is None else info
    out, rows = [], df
    for i, c in enumerate(df.columns):
        if c not in info:
            out.append(F.col(c))
        elif not is_string(df, c):
            out.append(F.col(c).cast("int").alias(c))
        elif isinstance(info[c][1], LevelTable):
            ranks = info[c][1].table.select(F.col("value").alias(f"_value{i}"), F.col("idx").alias(f"_idx{i}"))
            rows = rows.join(ranks, F.col(c) == F.col(f"_value{i}"), "left")
            out.append(F.col(f"_idx{i}").alias(c))
        else:
            vals = info[c][1]
            m = F.create_map(*[x for j, v in enumerate(vals) for x in (F.lit(v), F.lit(j))])
            out.append(m[F.col(c)].cast("int").alias(c))
    return rows.select(*out), info


# T7 / T8 -------------------------------------------------------------------
def fit_scaler(df: DataFrame, cols: list[str]) -> dict:
    return column_moments(df, cols)


def scale(df: DataFrame, cols: list[str], stats: dict, method: str = "standard",
          suffix: str = "") -> DataFrame:
    """standard: (x-mean)/pop_std (0 std -> 1); minmax: (x-min)/(max-min) (constant -> 0)."""
    if method not in ("standard", "minmax"):
        raise ValueError(f"unknown scaling method {method!r}")
    exprs = {}
    for c in cols:
        s = stats[c]
        x = F.col(c).cast("double")
        if method == "standard":
            sd = s["std_pop"] if s["std_pop"] else 1.0
            exprs[c + suffix] = (x - F.lit(s["mean"])) / F.lit(sd)
        else:
            rng = (s["max"] - s["min"]) if s["max"] is not None else 0.0
            exprs[c + suffix] = ((x - F.lit(s["min"])) / F.lit(rng)) if rng else F.lit(0.0)
    return df.withColumns(exprs)


# T9 ------------------------------------------------------------------------
def fit_iqr_bounds(df: DataFrame, cols: list[str], k: float = 1.5, exact: bool = True) -> dict:
    q = column_quantiles(df, cols, [0.25, 0.75], exact=exact)
    out = {}
    for c, (q1, q3) in q.items():
        if q1 is None:
            continue
        iqr = q3 - q1
        out[c] = (q1 - k * iqr, q3 + k * iqr)
    return out


def cap_iqr(df: DataFrame, spec: FeatureSpec, bounds: dict | None = None, k: float = 1.5,
            exact: bool = True, cols: list[str] | None = None) -> DataFrame:
    """Winsorise numeric columns to [Q1-k*IQR, Q3+k*IQR]."""
    cols = [c for c in (cols or spec.numeric) if c in df.columns]
    bounds = fit_iqr_bounds(df, cols, k, exact) if bounds is None else bounds
    return df.withColumns({c: F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi))
                           for c, (lo, hi) in bounds.items()})


def outlier_report(df: DataFrame, bounds: dict) -> DataFrame:
    """(column, outliers, lower_bound, upper_bound) for columns with >= 1 outlier.

    One pass: all counts in a single aggregate; output bounded by #columns.
    """
    cols = list(bounds)
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "column string, outliers bigint, lower_bound double, upper_bound double")
    counts = df.agg(*[F.count_if((F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1])).alias(f"o{i}")
                      for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', o{i}, cast({float(bounds[c][0])!r} as double), "
                      f"cast({float(bounds[c][1])!r} as double)" for i, c in enumerate(cols))
    return (counts.selectExpr(f"stack({len(cols)}, {pairs}) as (column, outliers, lower_bound, upper_bound)")
            .filter("outliers > 0"))


# P1 ------------------------------------------------------------------------
def split_xy(df: DataFrame, spec: FeatureSpec) -> tuple[DataFrame, DataFrame]:
    """Feature columns (with the key) and target column (with the key); error if the target is absent."""
    if not spec.target or spec.target not in df.columns:
        raise ValueError(f"target column {spec.target!r} not found")
    key = [k for k in spec.key if k in df.columns]
    feats = [c for c in df.columns if c != spec.target]
    return df.select(*feats), df.select(*key, spec.target)


# P2 ------------------------------------------------------------------------
def role_pipeline(spec: FeatureSpec, rows: int | None = None, scaling: str = "standard", out: str = "features"):
    """Column-role routing as an ML Pipeline: numeric columns assembled and
    scaled, categorical columns passed through unscaled, everything else
    dropped by the final assembler.

    Spark's StandardScaler divides by the sample std; with the number of
    ``rows`` it is fitted on, the result is brought to the population std of
    :func:`scale` by the constant sqrt(rows / (rows - 1)).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import ElementwiseProduct, MinMaxScaler, StandardScaler, VectorAssembler
    from pyspark.ml.linalg import Vectors
    num = VectorAssembler(inputCols=list(spec.numeric), outputCol="_num", handleInvalid="keep")
    stages, scaled = [num], "_num_s"
    if scaling == "standard":
        stages.append(StandardScaler(inputCol="_num", outputCol="_num_s", withMean=True, withStd=True))
        if rows and rows > 1:
            factor = [(rows / (rows - 1)) ** 0.5] * len(spec.numeric)
            stages.append(ElementwiseProduct(scalingVec=Vectors.dense(factor), inputCol="_num_s", outputCol="_num_p"))
            scaled = "_num_p"
    else:
        stages.append(MinMaxScaler(inputCol="_num", outputCol="_num_s"))
    cats = [c for c in spec.categorical if c not in spec.numeric]
    stages.append(VectorAssembler(inputCols=[scaled, *cats], outputCol=out, handleInvalid="keep"))
    return Pipeline(stages=stages)


# T12 -----------------------------------------------------------------------
@dataclass
class Preprocessed:
    data: DataFrame                      # all rows, cleaned/encoded/capped, with `split`
    scaled: DataFrame                    # same rows, scaled with train statistics
    encoding: dict = field(default_factory=dict)
    bounds: dict = field(default_factory=dict)
    scaler: dict = field(default_factory=dict)

    @property
    def train(self) -> DataFrame:
        return self.scaled.filter(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.scaled.filter(F.col("split") == "test")


def preprocess(df: DataFrame, spec: FeatureSpec, test_size: float = 0.2, seed: int = 42,
               scaling: str = "standard", cap_fit_on: str = "train", exact: bool = True) -> Preprocessed:
    """clean -> encode -> cap (bounds fitted on all rows or train) -> split -> scale (fit on train)."""
    from .split import add_split
    if scaling not in ("standard", "minmax"):
        raise ValueError(f"unknown scaling method {scaling!r}")
    cleaned, info = clean_with_levels(df, spec, exact=exact)   # one pass: fills + levels
    encoded, info = encode(cleaned, spec, info)
    split = add_split(encoded, spec, test_size=test_size, seed=seed)       # a projection of the coerced table, which is written
    fit_rows = split if cap_fit_on == "all" else split.filter(F.col("split") == "train")
    bounds = fit_iqr_bounds(fit_rows, list(spec.numeric), exact=exact)
    capped = cap_iqr(split, spec, bounds)
    train = capped.filter(F.col("split") == "train")
    stats = fit_scaler(train, list(spec.numeric))
    scaled = scale(capped, list(spec.numeric), stats, scaling)
    return Preprocessed(capped, scaled, info, bounds, stats)

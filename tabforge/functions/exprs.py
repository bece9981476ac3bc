"""Scalar functions as Column expressions (JVM-side, codegen-friendly).

Nothing here is a Python UDF: every helper returns a ``Column`` built from
``pyspark.sql.functions`` so it fuses into whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c, digits: int = 6) -> Column:
    """Round a double for stable comparison; ``+ 0.0`` folds -0.0 into 0.0."""
    return F.round(col_(c).cast("double"), digits) + F.lit(0.0)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column of ``df`` (report edge only)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(r6(f.name, digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# E1 --------------------------------------------------------------------------
def safe_divide(n, d, default: float = 0.0) -> Column:
    """n / d, or ``default`` when d is 0 (or NULL)."""
    return F.coalesce(F.try_divide(col_(n).cast("double"), col_(d).cast("double")),
                      F.lit(float(default)))


# E2 --------------------------------------------------------------------------
def format_percentage(v, decimals: int = 2) -> Column:
    return F.format_string(f"%.{int(decimals)}f%%", col_(v) * 100)


# E3 --------------------------------------------------------------------------
def truncate_string(s, max_length: int = 50, suffix: str = "...") -> Column:
    s = col_(s)
    keep = max(max_length - len(suffix), 0)
    return F.when(F.length(s) <= max_length, s).otherwise(
        F.concat(F.substring(s, 1, keep), F.lit(suffix)))


# E4 --------------------------------------------------------------------------
def title_name(s) -> Column:
    """``logistic_regression`` -> ``Logistic Regression``."""
    return F.initcap(F.regexp_replace(col_(s), "_", " "))


# E5 --------------------------------------------------------------------------
# Abramowitz & Stegun formula 7.1.26 for erf(x), x >= 0.
AS_P = 0.3275911
AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf(x) -> Column:
    x = col_(x).cast("double")
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(AS_P) * ax)
    poly = F.lit(0.0)
    for a in reversed(AS_A):
        poly = (poly + F.lit(a)) * t
    y = F.lit(1.0) - poly * F.exp(-ax * ax)
    return F.when(x < 0, -y).otherwise(y)


def normal_cdf(x, mean, std) -> Column:
    z = (col_(x) - col_(mean)) / (col_(std) * F.lit(2.0 ** 0.5))
    return F.lit(0.5) * (F.lit(1.0) + erf(z))


def normal_percentile(x, mean, std) -> Column:
    """Population percentile of ``x`` under N(mean, std), clamped to [0, 100]."""
    p = normal_cdf(x, mean, std) * 100
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), p))


# Z-score step table used when no CDF is available.
Z_STEPS = ((-2, 2.5), (-1, 16.0), (0, 50.0), (1, 84.0), (2, 97.5))
Z_TOP = 99.0


def step_percentile(x, mean, std) -> Column:
    z = F.when(col_(std) > 0, (col_(x) - col_(mean)) / col_(std)).otherwise(F.lit(0.0))
    out = None
    for edge, val in Z_STEPS:
        out = (F.when(z <= edge, F.lit(val)) if out is None
               else out.when(z <= edge, F.lit(val)))
    return out.otherwise(F.lit(Z_TOP))


# E6 --------------------------------------------------------------------------
def logistic_confidence(decision) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.abs(col_(decision))))


# E7 --------------------------------------------------------------------------
def format_ts(ts) -> Column:
    return F.date_format(col_(ts), "yyyy-MM-dd HH:mm")


# E8 --------------------------------------------------------------------------
def group_key(*cols) -> Column:
    return F.concat_ws("_", *[col_(c).cast("string") for c in cols])


def digamma(c) -> Column:
    """The digamma function for x > 0: its series after ten steps of the recurrence."""
    x = col_(c).cast("double")
    y = x + F.lit(10.0)
    steps = sum(((F.lit(1.0) / (x + F.lit(float(i)))) for i in range(1, 10)), F.lit(1.0) / x)
    i2 = F.lit(1.0) / (y * y)
    series = F.log(y) - F.lit(0.5) / y - i2 * (F.lit(1 / 12) - i2 * (F.lit(1 / 120) - i2 * (F.lit(1 / 252) - i2 * F.lit(1 / 240))))
    return series - steps

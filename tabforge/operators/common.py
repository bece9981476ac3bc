"""Shared building blocks: long (unpivoted) views and per-column statistics.

Per-column statistics are computed as ONE distributed aggregate and only
the result (one row per column, i.e. bounded by the schema, never by the
data) reaches the driver, exactly like a ``pyspark.ml`` ``fit``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC_TYPES)


def is_string(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Select numeric columns by type."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def long_values(df: DataFrame, cols: list[str], ids: list[str] | None = None,
                name: str = "column", value: str = "value",
                cast: str = "double") -> DataFrame:
    """Unpivot ``cols`` into ``(ids..., column, value)``.

    Spark plans this as an ``Expand`` that is pipelined into the following
    partial aggregate, so the d-fold row multiplication is never shuffled.
    """
    ids = list(ids or [])
    sel = [F.col(i) for i in ids] + [F.col(c).cast(cast).alias(c) for c in cols]
    return df.select(*sel).unpivot(ids, cols, name, value)


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                     exact: bool = True, accuracy: int = 10000) -> dict[str, list]:
    """Linear-interpolated quantiles per column, NULLs ignored; the result has
    one row per column.  ``exact=False`` takes them from a sketch instead."""
    from .quantiles import quantiles, value_counts_of

    out = {c: [None] * len(probs) for c in cols}
    if not cols:
        return out
    if exact:
        rows = quantiles(value_counts_of(df, cols), ["column"], probs)
    else:
        rows = long_values(df, cols).groupBy("column").agg(
            F.percentile_approx("value", [float(p) for p in probs], accuracy).alias("q"))
    for r in rows.collect():
        if r["q"] is not None:
            out[r["column"]] = list(r["q"])
    return out


def parallel_map(fn, items, parallelism: int = 4) -> list:
    """Run independent Spark jobs (model fits) concurrently from driver threads,
    as ``CrossValidator(parallelism=...)`` does; results keep item order."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as ex:
        return list(ex.map(fn, items))


@contextmanager
def held(df: DataFrame):
    """``df`` kept on memory and disk while a loop of fits reads it."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def column_moments(df: DataFrame, cols: list[str]) -> dict[str, dict]:
    """mean, population std, sample variance, min, max, count per column in one pass."""
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"sp{i}"),
                 F.var_samp(x).alias(f"vs{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}"), F.count(x).alias(f"n{i}")]
    r = df.agg(*aggs).first()
    return {c: {"mean": r[f"m{i}"], "std_pop": r[f"sp{i}"], "var_samp": r[f"vs{i}"],
                "min": r[f"lo{i}"], "max": r[f"hi{i}"], "count": r[f"n{i}"]}
            for i, c in enumerate(cols)}

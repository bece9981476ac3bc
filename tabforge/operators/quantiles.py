"""Exact quantiles, modes and levels from one distributed table of counts.

``value_counts_of`` reduces the data to (column, group..., value, cnt) with
map-side combination; everything else works on that table.  Exact quantiles
are found by rank: values are dealt into ranges by an approximate sketch, the
ranges' totals tell which range holds a wanted rank, and only these ranges are
sorted, each in its own task.  No task holds all values of a column.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import long_values

#: Ranges that the values of one column (and group) are dealt into.
RANGES = 64


def value_counts_of(df: DataFrame, cols: list[str], ids: list[str] | None = None,
                    cast: str = "double") -> DataFrame:
    """(column, ids..., value, cnt); a NULL value is counted like any other."""
    return (long_values(df, cols, ids=ids, cast=cast)
            .groupBy("column", *(ids or []), "value").agg(F.count(F.lit(1)).alias("cnt")))


def _same(keys: list[str], prefix: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def at_ranks(counts: DataFrame, keys: list[str], ranks: list, ranges: int = RANGES, written: bool = False) -> DataFrame:
    """(keys..., n, v0, v1, ...): the values at 0-based ranks of each key, from
    (keys..., value, cnt).  A rank is a function of ``n``, the key's number of
    non-NULL values; a rank outside 0 .. n-1 gives NULL.  A key without a
    non-NULL value has no row.  The counts are written, as three steps read them,
    unless they are a ``written`` table already; a value may have several counts."""
    counts = counts.filter(F.col("value").isNotNull())
    counts = counts if written else materialize(counts, "value-counts")
    cuts = counts.groupBy(*keys).agg(
        F.percentile_approx("value", [i / ranges for i in range(1, ranges)], 1000).alias("cuts"))
    cuts = cuts.select(*[F.col(k).alias(f"c_{k}") for k in keys], F.array_distinct("cuts").alias("cuts"))
    # one row per key on the right; Spark broadcasts it where it is small
    dealt = counts.join(cuts, _same(keys, "c_")).select(*keys, "value", "cnt", range_of(F.col("value"), "cuts", ranges - 1).alias("range"))
    return ranks_in(dealt, keys, ranks)


def range_of(value: Column, cuts: str, most: int) -> Column:
    """How many of the at most ``most`` ascending ``cuts`` lie below the value: every
    so many-th is asked, then those up to the next one.  (A lambda over the array
    runs outside the generated code, at some 20 microseconds a row.)"""
    def below(i) -> Column:
        return F.coalesce((F.get(cuts, i) < value).cast("int"), F.lit(0))

    step = max(1, math.isqrt(most))
    coarse = sum((below(F.lit(i)) for i in range(step - 1, most, step)), F.lit(0))
    first = coarse * step
    return first + sum((below(first + i) for i in range(step)), F.lit(0))


def ranks_in(dealt: DataFrame, keys: list[str], ranks: list, few_keys: bool = False) -> DataFrame:
    """:func:`at_ranks` of (keys..., value, cnt, range), ranges ascending with the
    values.  With ``few_keys`` the ranges that hold a rank are broadcast, and only
    the rows inside them move."""
    totals = dealt.groupBy(*keys, "range").agg(F.sum("cnt").alias("in_range"))
    per_key = Window.partitionBy(*keys)                       # one row a range
    totals = (totals.withColumn("before", F.sum("in_range").over(per_key.orderBy("range")) - F.col("in_range"))
              .withColumn("n", F.sum("in_range").over(per_key)))
    wanted = [r(F.col("n")) for r in ranks]
    hit = reduce(lambda a, b: a | b, [(F.col("before") <= r) & (r < F.col("before") + F.col("in_range")) for r in wanted])
    # the first range stays, so that a key has a row even if no rank lies inside
    totals = totals.filter(hit | (F.col("before") == 0)).select(
        *[F.col(k).alias(f"t_{k}") for k in keys], F.col("range").alias("t_range"), "before", "n")
    near = dealt.join(F.broadcast(totals) if few_keys else totals, _same(keys, "t_") & (F.col("range") == F.col("t_range")))
    run = Window.partitionBy(*keys, "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("end", F.col("before") + F.sum("cnt").over(run)).withColumn("start", F.col("end") - F.col("cnt"))
    at = [F.max(F.when((F.col("start") <= r) & (r < F.col("end")), F.col("value"))).alias(f"v{i}") for i, r in enumerate(wanted)]
    return near.groupBy(*keys).agg(F.max("n").alias("n"), *at)


def quantiles(counts: DataFrame, keys: list[str], probs: list[float], ranges: int = RANGES, written: bool = False) -> DataFrame:
    """(keys..., q): the linearly interpolated quantiles of each key, from
    (keys..., value, cnt).  NULL values are ignored; a key without any other
    value has no row."""
    def position(p):
        return lambda n: F.lit(float(p)) * (n - 1)

    ranks = [f for p in probs for f in (lambda n, at=position(p): F.floor(at(n)), lambda n, at=position(p): F.ceil(at(n)))]
    found = at_ranks(counts, keys, ranks, ranges, written)
    q = []
    for i, p in enumerate(probs):
        r, lo, hi = position(p)(F.col("n")), F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
        # equal neighbours are taken as they are: their weighted sum can miss them by a rounding error
        q.append(F.when((F.floor(r) == F.ceil(r)) | (lo == hi), lo).otherwise((F.ceil(r) - r) * lo + (r - F.floor(r)) * hi))
    return found.select(*keys, F.array(*q).alias("q"))


def modes(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., mode): the most frequent value, of equals the smallest."""
    top = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("cnt")).alias("c"), F.col("value").alias("v"))))
    return counts.groupBy(*keys).agg(top.alias("top")).select(*keys, F.col("top.v").alias("mode"))

"""Registry of named queries over the driver's tables, each with its oracle SQL.

A query is a function ``(spark, sf_dir) -> DataFrame``; its oracle is a
DuckDB-runnable SQL string over the same parquet tables (registered as
views).  Doubles are rounded to 6 decimals on both sides so that the two
engines' last-ulp differences do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.exprs import round_doubles

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, rounded: bool = True):
    """Register ``fn`` as query ``name`` (with optional oracle SQL); p-values
    are not ``rounded``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            return round_doubles(out) if rounded else out
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


def load_all() -> None:
    """Import every query module so that they register themselves."""
    from . import q_profile, q_clean, q_groups, q_stats, q_eval, q_score  # noqa: F401
    from . import q_models  # noqa: F401

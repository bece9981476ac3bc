"""File sources and sinks.

Readers never infer types on a large input: the CSV loader reads strings,
checks the header, then coerces with ``try_cast`` (unparseable -> NULL),
exactly one pass.  Writers are plain DataFrame writers; a rankings table is
written once, partitioned by method, instead of one file per method.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import FeatureSpec


class SchemaMismatch(ValueError):
    pass


# S1 ------------------------------------------------------------------------
def _checked(spark: SparkSession, path: str, columns: list[str], sep: str, header: bool) -> DataFrame:
    """All columns as strings.  The first file's header is checked here; with
    ``enforceSchema`` off Spark compares each file's own header with the schema
    when it opens the file, so a folder of differing files fails, too."""
    try:
        found = spark.read.option("header", header).option("sep", sep).csv(path).columns
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from e
        raise
    if not header and len(found) != len(columns):
        raise SchemaMismatch(f"Column mismatch. Expected {len(columns)} columns, found {len(found)}")
    if header and found != list(columns):
        missing, extra = sorted(set(columns) - set(found)), sorted(set(found) - set(columns))
        raise SchemaMismatch(f"Column mismatch. Missing: {missing}, Extra: {extra}")
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("header", header).option("sep", sep).option("enforceSchema", False).csv(path)


def load_csv_checked(spark: SparkSession, path: str, expected: list[str], target: str | None = None,
                     sep: str = ",", header: bool = True) -> DataFrame:
    """Every file's header must equal ``expected`` in order; all columns coerced
    to double (target to int).  Missing path -> FileNotFoundError; wrong header
    -> SchemaMismatch('Column mismatch. Missing: ..., Extra: ...'); a later
    file with another header fails the job that reads it."""
    raw = _checked(spark, path, expected, sep, header)
    out = []
    for c in expected:
        x = F.trim(F.col(c))
        out.append((x.try_cast("int") if c == target else x.try_cast("double")).alias(c))
    return raw.select(*out)


def load_spec_csv(spark: SparkSession, path: str, spec: FeatureSpec, columns: list[str],
                  sep: str = ",", header: bool = True) -> DataFrame:
    """S1 for a spec: raw strings kept (sentinels such as '?' handled by T1)."""
    return _checked(spark, path, columns, sep, header)


# S2 ------------------------------------------------------------------------
def load_typed(spark: SparkSession, path: str, schema: str | None = None, fmt: str | None = None) -> DataFrame:
    fmt = fmt or ("parquet" if path.endswith(".parquet") else "csv")
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if schema:
        r = r.schema(schema)
    return r.load(path)


# S3 ------------------------------------------------------------------------
def load_json(spark: SparkSession, path: str, schema: str | None = None, multiline: bool = True) -> DataFrame:
    r = spark.read.option("multiLine", multiline)
    if schema:
        r = r.schema(schema)
    return r.json(path)


# S4 / S6 / S8 / S9 / S10 ----------------------------------------------------
def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
         partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def save_bundle(root: str, splits: dict[str, DataFrame], fmt: str = "parquet") -> dict:
    """One dataset per split/name under ``root``."""
    return {name: save(df, f"{root.rstrip('/')}/{name}", fmt) for name, df in splits.items()}


# S5 ------------------------------------------------------------------------
def save_rankings(rankings: dict[str, DataFrame], path: str) -> str:
    """One long table (method, feature, score, rank, selected) partitioned by method."""
    parts = None
    for method, df in rankings.items():
        cols = df.columns
        score = next((c for c in ("score", "importance", "max_correlation") if c in cols), None)
        d = df.select(F.lit(method).alias("method"), "feature",
                      (F.col(score).cast("double") if score else F.lit(None).cast("double")).alias("score"),
                      (F.col("rank").cast("int") if "rank" in cols else
                       F.col("ranking").cast("int") if "ranking" in cols else F.lit(None).cast("int")).alias("rank"),
                      (F.col("selected") if "selected" in cols else F.lit(None).cast("boolean")).alias("selected"))
        parts = d if parts is None else parts.unionByName(d)
    return save(parts, path, partition_by=["method"])


# S7 ------------------------------------------------------------------------
def save_json(df: DataFrame, path: str) -> str:
    return save(df, path, fmt="json")

"""Table sources and the feature-table bindings built from them.

A binding joins/derives one feature table from the driver's parquet tables
and returns it with its :class:`FeatureSpec`.  Scans select only the
columns a binding needs, so Parquet column pruning and any later filter
push down to the file scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import FeatureSpec

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one table (column-pruned)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


# ---------------------------------------------------------------------------
# orderlines = lineitem JOIN orders.  One row per line item, keyed by
# (l_orderkey, l_linenumber).  Target "severity" is the order status as an
# ordinal (F=0, O=1, P=2); binarised it means "order not yet fulfilled".
# A zero discount or tax counts as "not recorded" (a numeric sentinel in the
# same role as the "-9" of the clinical raw files), so the cleaning operators
# have real gaps to fill.
# ---------------------------------------------------------------------------
ORDERLINES = FeatureSpec(
    key=("l_orderkey", "l_linenumber"),
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_returnflag", "l_linestatus", "l_linenumber"),
    ordinal=("l_linenumber",),
    target="severity",
    ranges={
        "l_quantity": (1, 50), "l_extendedprice": (1000, 100000),
        "l_discount": (0, 0.1), "l_tax": (0, 0.08), "l_linenumber": (1, 7),
        "severity": (0, 2),
    },
    missing_tokens={"l_discount": (0.0,), "l_tax": (0.0,)},
)


def orderlines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FeatureSpec]:
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    # Both sides are large fact tables: a shuffled equi-join on the order
    # key (AQE splits skewed keys).  No broadcast hint: orders grows with SF.
    df = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        F.when(F.col("o_orderstatus") == "F", 0)
         .when(F.col("o_orderstatus") == "O", 1)
         .when(F.col("o_orderstatus") == "P", 2).alias("severity"))
    return df, ORDERLINES


# ---------------------------------------------------------------------------
# docs = documents LEFT JOIN labels.  Text statistics over the whole text;
# quality is NULL for unlabelled documents, toxic likewise (a categorical
# with real gaps).
# ---------------------------------------------------------------------------
DOCS = FeatureSpec(
    key=("doc_id",),
    numeric=("n_chars", "n_lines", "n_digits"),
    categorical=("lang", "source", "toxic"),
    binary=("toxic",),
    target="quality",
    ranges={"n_chars": (1, 200000), "quality": (0, 1), "toxic": (0, 1)},
)


def docs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FeatureSpec]:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    text = F.col("text")
    df = d.join(lab, "doc_id", "left").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, "\n", "")) + 1).cast("double").alias("n_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, "[0-9]", ""))).cast("double").alias("n_digits"),
        "lang", "source", "toxic", "quality")
    return df, DOCS


# ---------------------------------------------------------------------------
# customers = customer JOIN nation (nation is a 25-row dimension; Spark's
# size-based broadcast threshold picks the strategy).
# ---------------------------------------------------------------------------
CUSTOMERS = FeatureSpec(
    key=("c_custkey",),
    numeric=("c_acctbal",),
    categorical=("c_mktsegment", "n_name"),
    target="in_debt",
    ranges={"c_acctbal": (-999.99, 9999.99)},
)


def customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FeatureSpec]:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    df = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", "c_acctbal", "c_mktsegment", "n_name",
        (F.col("c_acctbal") < 0).cast("int").alias("in_debt"))
    return df, CUSTOMERS


# ---------------------------------------------------------------------------
# users = events rolled up per user (partial aggregation map-side, then one
# shuffle on user_id).
# ---------------------------------------------------------------------------
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
USERS = FeatureSpec(
    key=("user_id",),
    numeric=("n_events", "avg_value", "max_value", "n_click", "n_error", "n_signup", "n_view"),
    target="has_purchase",
)


def users(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FeatureSpec]:
    ev = read_table(spark, sf_dir, "events", ["user_id", "event_type", "value"])
    aggs = [F.count(F.lit(1)).cast("double").alias("n_events"),
            F.avg("value").alias("avg_value"),
            F.max("value").alias("max_value")]
    for t in EVENT_TYPES:
        if t != "purchase":
            aggs.append(F.count_if(F.col("event_type") == t).cast("double").alias(f"n_{t}"))
    aggs.append(F.max((F.col("event_type") == "purchase").cast("int")).alias("has_purchase"))
    return ev.groupBy("user_id").agg(*aggs), USERS


# ---------------------------------------------------------------------------
# vectors = embeddings (64 float components, label 0-9).
# ---------------------------------------------------------------------------
def vectors(spark: SparkSession, sf_dir: str, dims: int = 64) -> tuple[DataFrame, FeatureSpec]:
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    comps = [F.col("embedding")[i].cast("double").alias(f"e{i:02d}") for i in range(dims)]
    spec = FeatureSpec(key=("vec_id",), numeric=tuple(f"e{i:02d}" for i in range(dims)), target="label")
    return e.select("vec_id", *comps, "label"), spec


BINDINGS = {
    "orderlines": orderlines,
    "docs": docs,
    "customers": customers,
    "users": users,
    "vectors": vectors,
}

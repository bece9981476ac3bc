"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and not a
    re-computation, and gives later joins the real size of the table.
    """
    path = scratch_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`materialize` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.written_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def doc_input(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)`` with null texts as empty ones."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def doc_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and ``rest``, a struct of all other columns, so that no
    name of theirs can clash with an operator's own."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.struct(*rest).alias("rest") if rest else F.lit(None).cast("struct<none:string>").alias("rest"))


def like_input(rows: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rows`` (doc_id, text, rest) with the columns of ``docs`` in their order."""
    own = {id_col: "doc_id", text_col: "text"}
    return rows.select(*[F.col(own[c] if c in own else f"rest.`{c}`").cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash128(*cols: Column) -> tuple[Column, Column]:
    """Two independently seeded 64-bit hashes of the columns."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(0x5DEECE66D), *cols)

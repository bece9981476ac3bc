"""Line deduplication against levelled sorted runs of line hashes.

Documents are taken in batches of rising ids.  A batch's distinct line hashes,
with the smallest document that holds each, are merge-anti-joined with every
earlier run; what is new is added as a run of its own.  A run is a table
bucketed and sorted by hash, so the merge join moves no row of it, and after
every ``FANOUT`` runs of a level these are compacted into one of the next.  In
the end all runs together hold each hash once, with its first document, and a
line goes if that document is not its own.

Hashes have 128 bits.  A line held by very many documents is one row for each
task after partial aggregation, and the last join has the document in its key,
so no line makes a hot key.

Edge cases: a null or empty text is one empty line; lines whose key is shorter
than ``min_chars`` always stay; rows with a null id keep all lines and make no
other row lose any; repeated rows of one id are one document; no rows give no
rows.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_path
from .common import doc_rows, hash128, materialize, shuffle_partitions

MIN_CHARS = 10
BATCHES = 6
FANOUT = 3
_STRIP = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends and with A-Z lower-cased."""
    bare = F.btrim(line, F.lit(_STRIP))
    plain = F.char_length(bare) == F.octet_length(bare)       # ASCII: lower() touches A-Z only
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def line_hashes(docs: DataFrame, *, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc, pos, h1, h2 of every line whose key is long enough."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.posexplode(
        F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n", -1)).alias("pos", "line"))
    rows = rows.select("doc", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    h1, h2 = hash128(F.col("key"))
    return rows.select("doc", "pos", h1.alias("h1"), h2.alias("h2"))


class Runs:
    """Levelled runs of (h1, h2, first): each a bucketed, sorted table."""

    def __init__(self, spark, fanout: int = FANOUT):
        self.spark, self.fanout, self.buckets = spark, fanout, shuffle_partitions(spark)
        self.name, self.levels, self.made = f"line_runs_{uuid.uuid4().hex}", [[]], 0

    def all(self) -> list[DataFrame]:
        return [self.spark.table(t) for level in self.levels for t in level]

    def _write(self, df: DataFrame) -> str:
        self.made += 1
        table = f"{self.name}_{self.made}"
        (df.repartition(self.buckets, "h1", "h2").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").format("parquet")
         .option("path", scratch_path(self.spark, f"llm/{table}")).saveAsTable(table))
        return table

    def add(self, first: DataFrame) -> None:
        """Anti-join ``first`` (h1, h2, first) with every run and keep the rest as a run."""
        for run in self.all():
            first = first.join(run, ["h1", "h2"], "left_anti")
        self.levels[0].append(self._write(first))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self.spark.table(self.levels[level][0])
            for t in self.levels[level][1:]:
                merged = merged.unionByName(self.spark.table(t))
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(merged))
            for t in self.levels[level]:
                self.spark.sql(f"DROP TABLE {t}")              # the catalog entry; the files are external
            self.levels[level] = []
            level += 1

    def union(self) -> DataFrame:
        out = None
        for run in self.all():
            out = run if out is None else out.unionByName(run)
        return out


def dropped_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                  batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """doc, gone: the sorted positions of the lines each document loses."""
    spark = docs.sparkSession
    marks = docs.select(F.percentile_approx(F.col(id_col).cast("long"), [i / batches for i in range(1, batches)], 1000)).first()[0]
    marks = sorted(set(marks or []))
    batch = F.lit(0)
    for m in marks:
        batch = batch + (F.col("doc") > m).cast("int")
    path = scratch_path(spark, f"llm/lines-{uuid.uuid4().hex}")
    line_hashes(docs, id_col=id_col, text_col=text_col, min_chars=min_chars).withColumn("batch", batch) \
        .write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc long, pos int, h1 long, h2 long, batch int").parquet(path)
    runs = Runs(spark, fanout)
    for i in range(len(marks) + 1):
        own = lines.where(F.col("batch") == i)
        runs.add(own.groupBy("h1", "h2").agg(F.min("doc").alias("first")))
    firsts = runs.union().withColumnRenamed("first", "doc")
    gone = lines.join(firsts, ["h1", "h2", "doc"], "left_anti")
    return materialize(gone.groupBy("doc").agg(F.sort_array(F.collect_set("pos")).alias("gone")), "gone-lines")


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """doc_id, text (freed of repeated lines), n_lines (before), n_dropped, and
    ``rest``: a struct of all other columns.  A text that loses nothing stays
    as it is, null included."""
    gone = dropped_lines(docs, id_col=id_col, text_col=text_col, min_chars=min_chars, batches=batches, fanout=fanout)
    # a merge join at every size: the texts are dealt out once, whatever the number of dropped lines
    rows = (doc_rows(docs, id_col, text_col).join(gone.hint("merge"), F.col("doc_id") == F.col("doc"), "left")
            .withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1)))
    # the stretches between dropped lines, one after the other
    d = F.col("gone")
    stretches = F.arrays_zip(F.concat(F.array(F.lit(0)), F.transform(d, lambda p: p + 1)).alias("s"),
                             F.concat(d, F.array(F.size("lines"))).alias("e"))
    kept = F.flatten(F.transform(stretches, lambda z: F.slice(F.col("lines"), z["s"] + 1, z["e"] - z["s"])))
    return rows.select("doc_id", F.when(d.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
                       F.size("lines").cast("long").alias("n_lines"),
                       F.when(d.isNull(), 0).otherwise(F.size(d)).cast("long").alias("n_dropped"), "rest")

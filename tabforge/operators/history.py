"""Prediction history in batches that can be written again, with retention (Z9, ST1).

A batch's rows go into a folder of their own; a record in a commit log then
names it.  Readers take, for every batch, the folder that was named last, so a
batch that is run again replaces its rows, and a writer that fails between rows
and record leaves nothing that is read.  ``compact`` keeps the newest rows in
one folder and names it as the base of all batches up to now.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path
from .commits import CommitLog
from .score import recent


class History:
    """``ts``: the column that tells a row's time; ``keep``: rows that compaction keeps."""

    def __init__(self, spark: SparkSession, root: str, schema, ts: str = "scored_at", keep: int = 50, compact_every: int = 20):
        self.spark, self.root, self.schema, self.ts = spark, root.rstrip("/"), schema, ts
        self.keep, self.compact_every = keep, compact_every
        self.log = CommitLog(spark, f"{self.root}/_log")

    def _write(self, df: DataFrame) -> str:
        path = f"{self.root}/rows-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def folders(self) -> tuple[str | None, dict]:
        """The base folder (or None) and {batch: folder} of the batches after it."""
        base, batches = None, {}
        for name in self.log.names():
            r = self.log.read(name)
            if r["kind"] == "base":
                base, done = r["path"], set(r["batches"])
                batches = {b: p for b, p in batches.items() if p not in done}
            else:
                batches[r["batch"]] = r["path"]
        return base, batches

    def write_batch(self, df: DataFrame, batch: int) -> None:
        """Write a batch, or replace it.  One that compaction has taken in already stays as it is."""
        if batch in self._compacted():
            return
        self.log.write({"kind": "batch", "batch": int(batch), "path": self._write(df)})
        if self.compact_every and len(self.folders()[1]) >= self.compact_every:
            self.compact()

    def _compacted(self) -> set:
        out: set = set()
        for name in self.log.names():
            r = self.log.read(name)
            if r["kind"] == "base":
                out |= set(r["ids"])
        return out

    def read(self) -> DataFrame:
        base, batches = self.folders()
        paths = ([base] if base else []) + list(batches.values())
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def latest(self, n: int = 10) -> DataFrame:
        return recent(self.read(), self.ts, n)

    def compact(self) -> None:
        """Keep the newest ``keep`` rows in one folder; folders that the base
        before this one has replaced are deleted (readers may still be at those of now)."""
        before, batches = self.folders()
        path = self._write(self.latest(self.keep))
        self.log.write({"kind": "base", "path": path, "ids": sorted(batches), "batches": sorted(batches.values()), "was": before})
        bases = [r for r in map(self.log.read, self.log.names()) if r["kind"] == "base"]
        if len(bases) > 1:
            last = bases[-2]
            for gone in last["batches"] + ([last["was"]] if last["was"] else []):
                delete_path(self.spark, gone)


def to_history(stream: DataFrame, history: History, checkpoint: str, available_now: bool = True):
    """Start a stream that writes every micro-batch into ``history`` under its id."""
    w = stream.writeStream.foreachBatch(lambda df, batch: history.write_batch(df, batch)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()

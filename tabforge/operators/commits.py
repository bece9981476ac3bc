"""A log of small JSON records in shared storage, for several writers at once.

Each record is a file of its own, written under a hidden name and then renamed,
so a reader sees a whole record or none, and an interrupted writer leaves
nothing behind that counts.  Names start with a number one above the largest
seen and end with a random part: writers that run at the same time get
different files, both stay, and all readers agree on their order.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        """Names of the records, oldest first."""
        if not self._fs.exists(self._root):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._root)]
        return sorted(n for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def write(self, record: dict) -> str:
        """Add a record; returns its name."""
        names = self.names()
        number = int(names[-1].split("-", 1)[0]) + 1 if names else 1
        name = f"{number:012d}-{uuid.uuid4().hex}.json"
        hidden, final = (self._root.suffix(f"/{n}") for n in (f".{name}", name))
        self._fs.mkdirs(self._root)
        out = self._fs.create(hidden, False)
        try:
            out.write(bytearray(json.dumps(record, default=str).encode()))
        finally:
            out.close()
        self._publish(hidden, final)
        return name

    def _publish(self, hidden, final) -> None:
        if not self._fs.rename(hidden, final):
            raise OSError(f"could not publish {final}")

    def read(self, name: str) -> dict:
        from py4j.java_gateway import java_import

        java_import(self.spark._jvm, "org.apache.commons.io.IOUtils")
        stream = self._fs.open(self._root.suffix(f"/{name}"))
        try:
            return json.loads(bytes(self.spark._jvm.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def last(self) -> dict | None:
        """The record with the largest name."""
        names = self.names()
        return self.read(names[-1]) if names else None

    def rows(self, schema: str) -> DataFrame:
        """All records as a table, also those that Spark wrote into sub-folders."""
        if not self._fs.exists(self._root):
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
        return reader.json(self.path)

"""Spark session helpers.

Library code never creates its own session: every function takes the
caller's ``SparkSession`` or a DataFrame.  These helpers are for tests,
``bench.py`` and command-line use only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at every scale: AQE re-plans shuffles at runtime
# (partition coalescing and skew-join splitting), timestamps are UTC so
# results match the DuckDB oracle, and Arrow carries pandas batches.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "tabforge",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return (or build) a session with the engine's base settings."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is only read here;
    there it must be set.  Only in local mode, where driver and executors are
    one process, a fresh scratch folder stands in for it.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="tabforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():       # each call makes a folder
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


#: Folders of the open :func:`scratch_run` blocks, the innermost last.
_RUNS: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder (inside the open run's folder,
    if there is one) for written intermediates."""
    base = _RUNS[-1] if _RUNS else ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of this library's own in the shared storage."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_run(spark: SparkSession):
    """Everything that queries write as intermediates inside the block goes into
    one folder, which is deleted at its end.  Results must have been written or
    collected by then, as they read these files."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    _RUNS.append(path)
    try:
        yield path
    finally:
        _RUNS.remove(path)
        delete_path(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and not a
    re-computation, and gives later joins the real size of the table.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

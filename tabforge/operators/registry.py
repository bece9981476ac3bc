"""Model registry (R1-R7): versioned ``PipelineModel`` folders plus a log of
metadata records (:mod:`commits`), all under one shared root.

A version is there once its record is: a save that was interrupted leaves files
that nothing names, saves that run at the same time both appear, and a
promotion is a new record, so readers see the old one until it is whole.

Versions are UTC timestamps (``yyyyMMdd_HHmmss_ffffff``) so the latest is
the lexicographic maximum.  A model's SHA-256 is computed by Spark over the
saved files (``binaryFile`` source, one hash per file, combined in
relative-path order -- part-file names are random, contents are not).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import CommitLog

SCHEMA = ("model_name string, version string, saved_at timestamp, model_type string, "
          "params map<string,string>, metrics map<string,double>, n_stages int, size_bytes bigint, "
          "sha256 string, path string")


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.table = f"{self.root}/_registry"
        self.log = CommitLog(spark, self.table)
        self.promotions = CommitLog(spark, f"{self.root}/_production")

    # R1 --------------------------------------------------------------------
    def save(self, name: str, model: PipelineModel, metrics: dict | None = None,
             params: dict | None = None) -> str:
        now = dt.datetime.now(dt.timezone.utc)
        version = now.strftime("%Y%m%d_%H%M%S_%f")
        path = f"{self.root}/{name}/{version}"
        model.write().save(path)                    # an error where another save has this very microsecond
        size, sha = self.fingerprint(path)
        last = model.stages[-1]
        self.log.write({"model_name": name, "version": version, "saved_at": now.isoformat(), "model_type": type(last).__name__,
                        "params": {k: str(v) for k, v in (params or {}).items()},
                        "metrics": {k: float(v) for k, v in (metrics or {}).items()},
                        "n_stages": len(model.stages), "size_bytes": size, "sha256": sha, "path": path})
        return version

    def import_versions(self, rows: DataFrame) -> None:
        """Records of many versions at once (columns of ``SCHEMA``), written by Spark."""
        rows.write.json(f"{self.table}/import-{uuid.uuid4().hex}")

    def fingerprint(self, path: str) -> tuple[int, str]:
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                 .select(F.col("path"), F.col("length"), F.sha2(F.col("content"), 256).alias("h")))
        rows = files.collect()  # one (path, hash, size) per saved file: bounded by the model layout
        prefix = path.rstrip("/")
        # part-file names are random: order by folder, then by content hash
        keyed = sorted((r["path"].split(prefix, 1)[-1].rsplit("/", 1)[0], r["h"], r["length"]) for r in rows
                       if not r["path"].rsplit("/", 1)[-1].startswith(("_", ".")))
        digest = hashlib.sha256("".join(h for _, h, _ in keyed).encode()).hexdigest()
        return int(sum(n for _, _, n in keyed)), digest

    # R4 --------------------------------------------------------------------
    def versions(self, name: str | None = None) -> DataFrame:
        df = self.log.rows(SCHEMA)
        df = df.filter(F.col("model_name") == name) if name else df
        return df.orderBy(F.desc("saved_at"), F.desc("version"))

    # R3 --------------------------------------------------------------------
    def latest(self, name: str) -> str | None:
        return self.versions(name).agg(F.max("version")).first()[0]

    def latest_versions(self) -> DataFrame:
        """(model_name, version) of the newest version of every model."""
        return self.versions().groupBy("model_name").agg(F.max("version").alias("version"))

    # R2 --------------------------------------------------------------------
    def load(self, name: str, version: str | None = None, validate: bool = False) -> PipelineModel:
        version = version or self.latest(name)
        if version is None:
            raise FileNotFoundError(f"no saved versions of {name!r}")
        row = self.versions(name).filter(F.col("version") == version).first()
        if row is None:
            raise FileNotFoundError(f"{name!r} has no version {version!r}")
        model = PipelineModel.load(row["path"])
        if validate:
            bad = [r for r in self.validate(name, version).collect() if not r["ok"]]
            if bad:
                raise ValueError(f"validation failed: {[r['check'] for r in bad]}")
        return model

    # R5 --------------------------------------------------------------------
    def validate(self, name: str, version: str, test: DataFrame | None = None, label: str = "label",
                 probe: DataFrame | None = None) -> DataFrame:
        """Checks (check, ok, detail): >= 2 stages, predicts on a probe row,
        stored hash matches the files, accuracy on ``test`` if given."""
        row = self.versions(name).filter(F.col("version") == version).first()
        model = PipelineModel.load(row["path"])
        checks = [("stages", len(model.stages) >= 2, str(len(model.stages)))]
        size, sha = self.fingerprint(row["path"])
        checks.append(("sha256", sha == row["sha256"], sha))
        if probe is not None:
            try:
                n = model.transform(probe.limit(1)).select("prediction").count()
                checks.append(("predict", n == 1, "probe row scored"))
            except Exception as e:  # noqa: BLE001
                checks.append(("predict", False, f"{type(e).__name__}"))
        if test is not None:
            acc = model.transform(test).agg(F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0]
            checks.append(("accuracy", acc is not None, f"{acc:.6f}" if acc is not None else "n/a"))
        return self.spark.createDataFrame(checks, "check string, ok boolean, detail string")

    # R6 --------------------------------------------------------------------
    def promote_best(self, metric: str = "accuracy") -> dict:
        """Best version over all models by ``metrics[metric]`` -> production record."""
        v = self.log.rows(SCHEMA).filter(F.col("metrics")[metric].isNotNull())
        best = v.orderBy(F.desc(F.col("metrics")[metric]), F.desc("version")).first()
        if best is None:
            raise ValueError(f"no version has metric {metric!r}")
        rec = {"model_name": best["model_name"], "version": best["version"], "path": best["path"],
               "metric": metric, "value": best["metrics"][metric],
               "promoted_at": dt.datetime.now(dt.timezone.utc).isoformat()}
        self.promotions.write(rec)
        return rec

    def production(self) -> dict | None:
        return self.promotions.last()

    # R7 --------------------------------------------------------------------
    def export(self, name: str, version: str, dest: str, requirements: tuple = ("pyspark",)) -> str:
        row = self.versions(name).filter(F.col("version") == version).first()
        PipelineModel.load(row["path"]).write().overwrite().save(f"{dest}/model")
        info = {k: (str(v) if not isinstance(v, (dict, int, float, str, type(None))) else v)
                for k, v in row.asDict().items()}
        info["requirements"] = list(requirements)
        self.spark.createDataFrame([(json.dumps(info, default=str),)], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{dest}/deployment_info")
        return dest

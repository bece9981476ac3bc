"""Registry and history: several writers, interrupted writers, batches that run again, retention."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabforge.operators import classify as M
from tabforge.operators.commits import CommitLog
from tabforge.operators.history import History, to_history
from tabforge.operators.registry import ModelRegistry
from tabforge.session import scratch_run

SCHEMA = "id long, scored_at timestamp"


def rows(spark, lo, n):
    return spark.range(lo, lo + n).select("id", F.timestamp_seconds(F.col("id")).alias("scored_at"))


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_log_keeps_what_all_writers_wrote(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.last() is None and log.names() == [] and log.rows("n int").count() == 0
    with ThreadPoolExecutor(8) as ex:
        list(ex.map(lambda i: CommitLog(spark, str(tmp_path / "log")).write({"n": i}), range(24)))
    assert sorted(r["n"] for r in log.rows("n int").collect()) == list(range(24))
    assert log.write({"n": 99}) == log.names()[-1] and log.last() == {"n": 99}


def test_registry_with_two_writers_and_an_interrupted_promotion(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(float(i % 7), float(i % 2)) for i in range(40)], "a double, label double")
    model = Pipeline(stages=[M.assembler(["a"]), M.logistic_regression(40)]).fit(df)
    root = str(tmp_path / "reg")
    with ThreadPoolExecutor(4) as ex:
        saved = list(ex.map(lambda i: ModelRegistry(spark, root).save(f"m{i % 2}", model, {"accuracy": i / 10}), range(6)))
    reg = ModelRegistry(spark, root)
    assert sorted(r["version"] for r in reg.versions().collect()) == sorted(saved) and reg.versions("m0").count() == 3
    assert reg.production() is None
    first = reg.promote_best()
    assert first["value"] == 0.5 and reg.production()["version"] == first["version"]
    best = reg.save("m9", model, {"accuracy": 0.9})

    def broken(*a):
        raise OSError("lost the connection")

    monkeypatch.setattr(reg.promotions, "_publish", broken)
    with pytest.raises(OSError):
        reg.promote_best()
    assert ModelRegistry(spark, root).production()["version"] == first["version"]      # the old record
    monkeypatch.undo()
    reg.promote_best()
    assert reg.production()["version"] == best and reg.load("m9").stages


def test_a_batch_that_runs_again_leaves_one_copy(spark, tmp_path, monkeypatch):
    h = History(spark, str(tmp_path / "h"), SCHEMA, compact_every=0)
    assert h.read().count() == 0
    h.write_batch(rows(spark, 0, 5), 0)
    h.write_batch(rows(spark, 5, 5), 1)
    # rows written, record not: nothing of it is read
    real = h.log.write
    monkeypatch.setattr(h.log, "write", lambda r: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        h.write_batch(rows(spark, 10, 5), 2)
    monkeypatch.setattr(h.log, "write", real)
    assert ids(h.read()) == list(range(10))
    h.write_batch(rows(spark, 10, 5), 2)
    h.write_batch(rows(spark, 5, 5), 1)                               # once more
    assert ids(History(spark, str(tmp_path / "h"), SCHEMA).read()) == list(range(15))
    assert [r["id"] for r in h.latest(3).collect()] == [14, 13, 12]


def test_compaction_keeps_the_newest_rows(spark, tmp_path):
    h = History(spark, str(tmp_path / "h"), SCHEMA, keep=7, compact_every=3)
    for b in range(8):
        h.write_batch(rows(spark, b * 4, 4), b)
    # batches 0-2 and 3-5 were compacted, 6 and 7 came after
    assert ids(h.read()) == list(range(17, 32))
    h.write_batch(rows(spark, 0, 4), 0)                               # long compacted: stays as it is
    h.compact()
    assert ids(h.read()) == list(range(25, 32))
    assert ids(History(spark, str(tmp_path / "h"), SCHEMA).read()) == list(range(25, 32))
    h.compact()
    folders = [f for f in os.listdir(tmp_path / "h") if f.startswith("rows-")]
    assert len(folders) <= 3 and ids(h.read()) == list(range(25, 32))


def test_stream_into_history(spark, tmp_path):
    for i in range(3):
        rows(spark, i * 10, 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    h = History(spark, str(tmp_path / "h"), SCHEMA, keep=12, compact_every=2)
    for _ in range(2):                                                # the second run finds nothing new
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        to_history(stream, h, str(tmp_path / "ck")).awaitTermination()
    assert set(range(18, 30)) <= set(ids(h.read()))
    h.compact()
    assert ids(h.read()) == list(range(18, 30))


def test_run_folder_is_empty_after_the_run(spark, tmp_path):
    from tabforge.session import ensure_checkpoint_dir, materialize
    base = ensure_checkpoint_dir(spark)
    before = set(os.listdir(base))
    with scratch_run(spark):
        df = materialize(spark.range(10).toDF("id"), "numbers")
        df.write.parquet(str(tmp_path / "out"))
        assert set(os.listdir(base)) != before
    assert set(os.listdir(base)) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10

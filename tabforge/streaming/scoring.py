"""Continuous scoring (ST1): validate -> score -> interpret -> append history.

A Structured Streaming query over a file source.  Every step is a
stateless projection, so the stream needs no state store; the checkpoint
folder (under the cluster's shared ``spark.checkpoint.dir`` unless given)
records which input files were processed, so a restarted or re-run query
never scores a file twice and a lost executor only re-runs its task.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as RL
from ..operators import score as Z
from ..operators.history import History, to_history
from ..session import scratch_path


def scoring_frame(stream: DataFrame, model: PipelineModel, rules: RL.RuleSet,
                  request_rules: dict | None = None, labels: dict | None = None) -> DataFrame:
    """The per-row transformation shared by batch and streaming scoring."""
    out = stream
    if request_rules:
        req = Z.request_map(list(request_rules))
        out = out.withColumn("error", Z.request_error(req, request_rules, labels or {}))
    scored = model.transform(out)
    # an invalid request gets its error and no score
    valid = F.col("error").isNull() if request_rules else F.lit(True)
    conf = F.when(valid, F.array_max(vector_to_array("probability")))
    pred = F.when(valid, F.col("prediction")).cast("int")
    return (scored.withColumn("confidence", conf)
                  .withColumn("prediction", pred)
                  .withColumn("confidence_level", F.when(valid, Z.confidence_band(F.col("confidence"))))
                  .withColumn("risk_category", F.when(valid, Z.risk_category(F.col("prediction"))))
                  .withColumn("risk_factors", F.when(valid, RL.factors(rules.risk)))
                  .withColumn("protective_factors", F.when(valid, RL.factors(rules.protective)))
                  .withColumn("scored_at", F.current_timestamp())
                  .drop("features", "rawPrediction", "probability"))


def score_stream(spark: SparkSession, source: str, schema, model: PipelineModel, sink: str,
                 rules: RL.RuleSet, checkpoint: str | None = None, request_rules: dict | None = None,
                 labels: dict | None = None, available_now: bool = True, max_files: int | None = None,
                 glob: str | None = None, keep: int | None = None):
    """Start the stream over the files of ``source``, a folder or a path pattern
    (optionally only those matching ``glob``); with ``available_now`` it
    processes what is there and stops.  ``sink`` gets Parquet files of all rows,
    or, with ``keep``, a :class:`History` that keeps the newest ``keep`` rows."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.parquet(source)
    out = scoring_frame(stream, model, rules, request_rules, labels)
    ck = checkpoint or scratch_path(spark, "stream-score-checkpoint")
    if keep is not None:
        return to_history(out, History(spark, sink, out.schema, keep=keep), ck, available_now)
    w = out.writeStream.format("parquet").option("checkpointLocation", ck).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(sink)

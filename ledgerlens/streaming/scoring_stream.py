"""Structured Streaming scoring of incoming transactions.

``readStream`` (file source, declared schema) -> the fitted features+model
``PipelineModel`` -> parquet sink with a checkpoint.  Every arriving row leaves
in the same pass: scored, or, where the pipeline can't score it (an unseen
category, a missing number), with a null score and the row as it came, in a
folder of its own.  ``trigger(availableNow)`` drains what has arrived in bounded
micro-batches and stops; the checkpoint makes a restarted run resume exactly
where it stopped, and the parquet sink is exactly-once through its commit log,
so a batch that is run again after a failure adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.scoring import SCORED, scored_columns, transform_all


DEFAULT_MAX_FILES_PER_TRIGGER = 1000
#: The sink's folders: ``outcome=scored`` and ``outcome=rejected``.
OUTCOME, GIVEN = "outcome", "given"
SCORED_ROWS, REJECTED_ROWS = "scored", "rejected"


def scored_stream(spark: SparkSession, model: PipelineModel, source_dir: str,
                  schema: T.StructType, keep: Sequence[str] = ("txn_id",),
                  digits: int | None = None,
                  max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Every arriving row with its score, its ``outcome``, and, if rejected, the
    row as it came (``given``).

    Bounded micro-batches: a backlog is drained in batches of at most
    ``max_files_per_trigger`` files, each committed to the checkpoint, so a
    failure replays one batch, not the whole backlog."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(source_dir)
    pred = transform_all(model, rows)
    pred = pred.withColumns({OUTCOME: F.when(F.col(SCORED), SCORED_ROWS).otherwise(REJECTED_ROWS),
                             GIVEN: F.when(~F.col(SCORED), F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]))})
    return scored_columns(pred, [*keep, OUTCOME, GIVEN], digits)


def drain_to_sink(stream: DataFrame, sink_dir: str, checkpoint_dir: str,
                  timeout_s: float | None = None) -> StreamingQuery:
    q = (stream.writeStream.format("parquet")
         .partitionBy(OUTCOME)
         .option("checkpointLocation", checkpoint_dir)
         .outputMode("append")
         .trigger(availableNow=True)
         .start(sink_dir))
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if timeout_s and not finished and q.isActive:
        q.stop()          # progress so far is committed; a re-run resumes from the checkpoint
        raise TimeoutError(f"streaming scoring did not drain within {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(f"streaming scoring failed: {q.exception()}")
    return q


def score_stream(spark: SparkSession, model: PipelineModel, source_dir: str, sink_dir: str,
                 checkpoint_dir: str, schema: T.StructType, keep: Sequence[str] = ("txn_id",),
                 digits: int | None = None) -> DataFrame:
    """Drain ``source_dir`` through the model into ``sink_dir``; return the whole
    sink read back as a batch DataFrame, a row for every row that came."""
    stream = scored_stream(spark, model, source_dir, schema, keep, digits)
    drain_to_sink(stream, sink_dir, checkpoint_dir)
    return spark.read.schema(stream.schema).parquet(sink_dir).drop(OUTCOME, GIVEN)


def rejected_rows(spark: SparkSession, sink_dir: str, schema: T.StructType) -> DataFrame:
    """The rows that a sink holds as rejected, as they came."""
    sink = spark.read.schema(T.StructType([T.StructField(GIVEN, schema), T.StructField(OUTCOME, T.StringType())])).parquet(sink_dir)
    return sink.filter(F.col(OUTCOME) == REJECTED_ROWS).select(f"{GIVEN}.*")

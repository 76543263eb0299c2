"""Batch scoring with a fitted features+model ``PipelineModel`` (map-only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import fixed4, label_text, over_threshold


SCORED = "_scored"


def scored_columns(pred: DataFrame, keep: Sequence[str] = ("txn_id",), digits: int | None = None) -> DataFrame:
    """txn_id, probability (of fraud), prediction (int), label_text, probability_text.

    The threshold applies to the probability as it is; ``digits`` rounds what
    is shown.  A model without a probability (the cluster detector) keeps its
    own prediction, and the probability is null.  Rows of :func:`transform_all`
    that could not be scored have neither.
    """
    if "probability" in pred.columns:
        p = vector_to_array(F.col("probability"))[1]
        decided = over_threshold(p)
    else:
        p, decided = F.lit(None).cast("double"), F.col("prediction").cast("int")
    if SCORED in pred.columns:
        p, decided = F.when(F.col(SCORED), p), F.when(F.col(SCORED), decided)
    shown = p if digits is None else F.round(p, digits)
    return (pred.select(*keep, shown.alias("probability"), decided.alias("prediction"))
                .withColumn("label_text", label_text("prediction"))
                .withColumn("probability_text", fixed4("probability")))


def scorable(model: PipelineModel, columns: Sequence[str]) -> Column:
    """Whether a row has what the fitted pipeline needs: a known category where an
    indexer stops on others, and numbers where an assembler stops on missing ones.
    ``columns`` are those of the rows (a pipeline's own columns are not tested)."""
    ok = F.lit(True)
    for stage in model.stages:
        if isinstance(stage, PipelineModel):
            ok = ok & scorable(stage, columns)
        elif isinstance(stage, StringIndexerModel) and stage.getHandleInvalid() == "error":
            ok = ok & F.coalesce(F.col(stage.getInputCol()).isin(list(stage.labels)), F.lit(False))
        elif isinstance(stage, VectorAssembler) and stage.getHandleInvalid() == "error":
            for c in stage.getInputCols():
                if c in columns:
                    ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return ok


def _stand_ins(model: PipelineModel, columns: Sequence[str]) -> dict[str, object]:
    """For each column that :func:`scorable` tests a value that the pipeline accepts."""
    out: dict[str, object] = {}
    for stage in model.stages:
        if isinstance(stage, PipelineModel):
            out |= _stand_ins(stage, columns)
        elif isinstance(stage, StringIndexerModel) and stage.getHandleInvalid() == "error" and len(stage.labels):
            out[stage.getInputCol()] = stage.labels[0]
        elif isinstance(stage, VectorAssembler) and stage.getHandleInvalid() == "error":
            out |= {c: 0.0 for c in stage.getInputCols() if c in columns}
    return out


def transform_all(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``model.transform(df)`` for every row, in one pass: rows that the pipeline
    can't take go through it with stand-in values and are marked by ``_scored`` =
    false; they come out with their own values, and what the model made of the
    stand-ins is to be ignored."""
    tested = {c: v for c, v in _stand_ins(model, df.columns).items() if c in df.columns}
    kept = {c: f"_given_{i}" for i, c in enumerate(tested)}
    ready = df.withColumn(SCORED, scorable(model, df.columns)).withColumns({k: F.col(c) for c, k in kept.items()})
    ready = ready.withColumns({c: F.when(F.col(SCORED), F.col(c)).otherwise(F.lit(v).cast(df.schema[c].dataType)) for c, v in tested.items()})
    return model.transform(ready).withColumns({c: F.col(k) for c, k in kept.items()}).drop(*kept.values())


def score_batch(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("txn_id",),
                digits: int | None = None) -> DataFrame:
    """Every row of ``df`` with its score; null where the pipeline can't score it
    (an unseen category, a missing number)."""
    return scored_columns(transform_all(model, df), keep, digits)

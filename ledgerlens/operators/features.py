"""Feature engineering: balance deltas, class weights, and the Spark ML
feature pipeline (index -> one-hot -> assemble -> scale, optional PCA).

Estimators are fitted on the training side only; every ``fit`` here is a
distributed aggregation (label frequencies, column moments), and ``transform``
is a map-only projection with no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schema import LABEL, NUMERIC_FEATURES, TYPE, TYPE_ORDINALS, WEIGHT_COL, WIDE_EXTRA_FEATURES
from .joins import join_small

BALANCE_TOLERANCE = 0.01


def with_balance_deltas(df: DataFrame) -> DataFrame:
    """deltaOrig, deltaDest and balanceMismatch (our definitions; the saved
    pipelines name these inputs without publishing formulas)."""
    d_orig = F.col("oldbalanceOrg") - F.col("newbalanceOrig")
    d_dest = F.col("newbalanceDest") - F.col("oldbalanceDest")
    mismatch = ((F.abs(d_orig - F.col("amount")) > F.lit(BALANCE_TOLERANCE))
                | (F.abs(d_dest - F.col("amount")) > F.lit(BALANCE_TOLERANCE)))
    return (df.withColumn("deltaOrig", d_orig)
              .withColumn("deltaDest", d_dest)
              .withColumn("balanceMismatch", F.coalesce(mismatch, F.lit(False)).cast("double")))


def balance_deltas_stage() -> SQLTransformer:
    """:func:`with_balance_deltas` as a stage that is saved with a pipeline."""
    origin, dest = "(oldbalanceOrg - newbalanceOrig)", "(newbalanceDest - oldbalanceDest)"
    mismatch = f"abs({origin} - amount) > {BALANCE_TOLERANCE}D OR abs({dest} - amount) > {BALANCE_TOLERANCE}D"
    return SQLTransformer(statement=f"SELECT *, {origin} AS deltaOrig, {dest} AS deltaDest, "
                                    f"CAST(coalesce({mismatch}, false) AS DOUBLE) AS balanceMismatch FROM __THIS__")


def type_code_stage() -> SQLTransformer:
    """The type's fixed code as a number (unknown types: NULL), saved with a pipeline."""
    codes = " ".join(f"WHEN '{k}' THEN {float(v)}D" for k, v in TYPE_ORDINALS.items())
    return SQLTransformer(statement=f"SELECT *, CASE {TYPE} {codes} END AS type_code FROM __THIS__")


def class_weight_table(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, weight) with weight = n / (2 * n_class), n over labels {0, 1}.

    One global aggregate (partial counts per task) gives a single row, which
    is unfolded into at most two rows -- a proven bound for the broadcast.
    """
    c = df.agg(F.count_if(F.col(label) == 0.0).alias("n0"),
               F.count_if(F.col(label) == 1.0).alias("n1"))
    n = F.col("n0") + F.col("n1")
    rows = F.array(
        F.struct(F.lit(0.0).alias(label), F.try_divide(n, F.lit(2.0) * F.col("n0")).alias(WEIGHT_COL)),
        F.struct(F.lit(1.0).alias(label), F.try_divide(n, F.lit(2.0) * F.col("n1")).alias(WEIGHT_COL)),
    )
    return c.select(F.inline(rows)).filter(F.col(WEIGHT_COL).isNotNull())


def with_class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Attach the balanced class weight.  The weight table has a proven bound
    of two rows, so it is broadcast; the large side is never shuffled."""
    return join_small(df, class_weight_table(df, label), label, "left", small_rows=2)


def feature_stages(wide: bool = False, keep_invalid: bool = False, scale: bool = True,
                   numeric: Sequence[str] | None = None, type_col: str = TYPE,
                   out: str = "features") -> list:
    """Stage list for the feature pipeline.

    narrow: 5 numbers + one-hot(type), errors on unseen type / null number.
    wide:   8 numbers (with deltas) + one-hot with an "unseen" slot,
            NULL numbers become NaN (``handleInvalid=keep`` throughout).
    """
    handle = "keep" if (keep_invalid or wide) else "error"
    nums = list(numeric) if numeric is not None else (
        NUMERIC_FEATURES + WIDE_EXTRA_FEATURES if wide else list(NUMERIC_FEATURES))
    stages = [
        StringIndexer(inputCol=type_col, outputCol="type_index", handleInvalid=handle),
        OneHotEncoder(inputCols=["type_index"], outputCols=["type_ohe"], dropLast=True,
                      handleInvalid=handle),
        VectorAssembler(inputCols=nums + ["type_ohe"],
                        outputCol="features_raw" if scale else out, handleInvalid=handle),
    ]
    if scale:
        stages.append(StandardScaler(inputCol="features_raw", outputCol=out,
                                     withStd=True, withMean=False))
    return stages


def fit_features(train: DataFrame, **kw) -> PipelineModel:
    return Pipeline(stages=feature_stages(**kw)).fit(train)


def pca_stage(k: int, input_col: str = "features", output_col: str = "pcaFeatures") -> PCA:
    return PCA(k=k, inputCol=input_col, outputCol=output_col)


def vector_columns(df: DataFrame, vec_col: str, width: int, prefix: str = "f",
                   keep: Sequence[str] = ("txn_id",)) -> DataFrame:
    """Expose a vector as scalar columns f0..f{width-1} (never return VectorUDT)."""
    arr = vector_to_array(F.col(vec_col))
    return df.select(*keep, *[arr[i].alias(f"{prefix}{i}") for i in range(width)])


def string_index_model(pipeline: PipelineModel):
    return pipeline.stages[0]


def pca_sign_flips(components: list[list[float]]) -> list[float]:
    """+1/-1 per principal component so that its largest-magnitude loading
    becomes positive (component signs are arbitrary)."""
    flips = []
    for comp in components:
        j = max(range(len(comp)), key=lambda i: abs(comp[i]))
        flips.append(-1.0 if comp[j] < 0 else 1.0)
    return flips


def normalise_pca_signs(components: list[list[float]]) -> list[list[float]]:
    return [[f * v for v in comp] for f, comp in zip(pca_sign_flips(components), components)]

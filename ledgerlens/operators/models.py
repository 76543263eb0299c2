"""Estimators and persistence (the model registry lives in plans/training.py).

All models are Spark ML estimators: their fits are distributed
(``treeAggregate`` per iteration for LR / KMeans, per-level histogram
aggregation for trees).  Features and model are always saved together as one
``PipelineModel`` so scoring cannot drift from training.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler

from ..sources.schema import (
    BOOST_MAX_DEPTH, BOOST_ROUNDS, BOOST_STEP, DEFAULT_SEED, FORM_NUMBERS, KMEANS_K, LABEL, LR_MAX_ITER,
    RF_MAX_DEPTH, RF_NUM_TREES, WEIGHT_COL, WIDE_LR_MAX_ITER,
)


def logistic_regression(max_iter: int = LR_MAX_ITER, features: str = "features",
                        label: str = LABEL, **kw) -> LogisticRegression:
    return LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter, **kw)


def weighted_logistic_regression(features: str = "features", label: str = LABEL,
                                 max_iter: int = WIDE_LR_MAX_ITER, **kw) -> LogisticRegression:
    """Binomial, unregularised, balanced by ``classWeightCol``."""
    params = dict(maxIter=max_iter, family="binomial", elasticNetParam=0.0, regParam=0.0,
                  weightCol=WEIGHT_COL)
    params.update(kw)
    return LogisticRegression(featuresCol=features, labelCol=label, **params)


def random_forest(seed: int = DEFAULT_SEED, num_trees: int = RF_NUM_TREES,
                  max_depth: int = RF_MAX_DEPTH, features: str = "features",
                  label: str = LABEL, **kw) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed, **kw)


def xgboost_available() -> bool:
    try:
        import xgboost.spark  # noqa: F401
    except Exception:
        return False
    return True


def boosted_trees(seed: int = DEFAULT_SEED, rounds: int = BOOST_ROUNDS,
                  max_depth: int = BOOST_MAX_DEPTH, step: float = BOOST_STEP,
                  features: str = "features", label: str = LABEL, engine: str = "gbt", **kw):
    """Gradient-boosted trees.  ``engine="gbt"`` (default) is Spark's
    GBTClassifier; ``engine="xgboost"`` uses ``xgboost.spark`` (zeros treated as
    missing, as in the reference's settings) and fails where it is not installed."""
    if engine == "xgboost":
        if not xgboost_available():
            raise ModuleNotFoundError("engine xgboost needs the xgboost package")
        from xgboost.spark import SparkXGBClassifier

        return SparkXGBClassifier(features_col=features, label_col=label, missing=0.0,
                                  learning_rate=step, max_depth=max_depth, n_estimators=rounds,
                                  objective="binary:logistic", random_state=seed, **kw)
    return GBTClassifier(featuresCol=features, labelCol=label, maxIter=rounds,
                         maxDepth=max_depth, stepSize=step, seed=seed, **kw)


def form_pipeline(**kw) -> Pipeline:
    """The scoring form's model: amount, the two origin balances and the type's
    fixed code, without the other columns of a transaction.  Unknown types and the
    type of code 0 are missing values, as zeros are."""
    from . import features as feat
    from .boosting import SecondOrderBoosting

    assemble = VectorAssembler(inputCols=[*FORM_NUMBERS, "type_code"], outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[feat.type_code_stage(), assemble, SecondOrderBoosting(**kw)])


def kmeans(k: int = KMEANS_K, seed: int = DEFAULT_SEED, features: str = "pcaFeatures", **kw) -> KMeans:
    return KMeans(k=k, featuresCol=features, seed=seed, **kw)


def full_pipeline(feature_stages: list, estimator) -> Pipeline:
    return Pipeline(stages=list(feature_stages) + [estimator])


def combine(feature_model: PipelineModel, model) -> PipelineModel:
    """Fitted features + fitted model as one artifact."""
    return PipelineModel(stages=list(feature_model.stages) + [model])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

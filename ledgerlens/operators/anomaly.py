"""Cluster-based anomaly detector: PCA(k) -> KMeans(2) -> majority map ->
distance-to-fraud-centre score.

Everything after the fit is one lazy plan: the cluster fraud rates are a
grouped average (partial aggregation; at most k groups), the fraud cluster is
picked by a global ``max_by`` delivered as a scalar subquery, and the score is
a built-in array expression (no Python UDF).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import squared_distance
from ..sources.schema import CLUSTER_MAJORITY_RATE, DEFAULT_SEED, KMEANS_K, LABEL, PCA_K
from .features import pca_stage
from .models import kmeans
from .parallel import side_by_side


def group_rates(pred: DataFrame, group: str = "prediction", label: str = LABEL) -> DataFrame:
    """Average label per group (cluster)."""
    return pred.groupBy(group).agg(F.avg(F.col(label)).alias("rate"))


def pick_majority_group(rates: DataFrame, group: str = "prediction",
                        min_rate: float = CLUSTER_MAJORITY_RATE, fallback: int = 0) -> DataFrame:
    """The group whose rate is >= ``min_rate`` (highest rate, then lowest id);
    ``fallback`` when none qualifies.  One row, one column ``fraud_cluster``."""
    key = F.struct(F.col("rate"), (-F.col(group)).alias("neg_id"))
    best = F.max_by(F.col(group), F.when(F.col("rate") >= F.lit(float(min_rate)), key))
    return rates.agg(F.coalesce(best, F.lit(fallback)).cast("int").alias("fraud_cluster"))


def remap_to_class(cluster: Column | str, fraud_cluster: Column) -> Column:
    c = F.col(cluster) if isinstance(cluster, str) else cluster
    return F.when(c == fraud_cluster, F.lit(1)).otherwise(F.lit(0))


def distance_score(points: Column, centre: Column | list[float]) -> Column:
    """Negated squared distance: higher = nearer the fraud centre."""
    return -squared_distance(points, centre)


#: Seeded starts of the cluster fit; the one of the lowest training cost is kept.
STARTS = 3


def fit_anomaly(train_features: DataFrame, k_pca: int = PCA_K, k: int = KMEANS_K,
                seed: int = DEFAULT_SEED, features: str = "features", starts: int = STARTS, **kw) -> PipelineModel:
    """PCA, then KMeans from ``starts`` seeds, side by side on the projected rows;
    a single start may end in a poor optimum.  Among equal costs the first seed wins."""
    pca = pca_stage(k_pca, features).fit(train_features)
    points = pca.transform(train_features).select("pcaFeatures").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        points.count()
        made = side_by_side(train_features.sparkSession, [(f"start-{i}", lambda i=i: kmeans(k=k, seed=seed + i, **kw).fit(points)) for i in range(starts)])
    finally:
        points.unpersist()
    return PipelineModel(stages=[pca, min(made, key=lambda m: m.summary.trainingCost)])


def anomaly_predictions(model: PipelineModel, test_features: DataFrame,
                        map_features: DataFrame | None = None, label: str = LABEL, fallback: str = "first") -> DataFrame:
    """Score ``test_features``.  Clusters are mapped to classes with the labels
    of ``map_features`` (the training side by default; pass the test side to
    reproduce the original leakage-prone mapping).  ``fallback``: see
    :func:`fallback_cluster`."""
    mapped_on = model.transform(map_features if map_features is not None else test_features)
    rates = group_rates(mapped_on, "prediction", label)
    fraud_cluster = pick_majority_group(rates, fallback=fallback_cluster(rates, fallback)).scalar()
    centres = [[float(v) for v in c] for c in model.stages[-1].clusterCenters()]
    centre_table = F.array(*[F.array(*[F.lit(v) for v in c]) for c in centres])
    pred = model.transform(test_features)
    return (pred
            .withColumn("fraud_cluster", fraud_cluster)
            .withColumn("fraud_centre", F.element_at(centre_table, F.col("fraud_cluster") + 1))
            .withColumn("rawPrediction",
                        distance_score(vector_to_array(F.col("pcaFeatures")), F.col("fraud_centre")))
            .withColumn("prediction", remap_to_class("prediction", F.col("fraud_cluster")))
            .drop("fraud_centre"))


def scoring_pipeline(features: PipelineModel, model: PipelineModel, map_features: DataFrame, label: str = LABEL,
                     fallback: str = "first") -> PipelineModel:
    """Features, PCA, clusters and their classes as one pipeline whose
    ``prediction`` is the class; the fraud cluster is found on ``map_features``."""
    rates = group_rates(model.transform(map_features), "prediction", label)
    fraud = pick_majority_group(rates, "prediction", fallback=fallback_cluster(rates, fallback)).first().fraud_cluster
    *before, clusters = model.stages
    named = clusters.copy().setPredictionCol("cluster")
    mapped = SQLTransformer(statement=f"SELECT *, CAST(cluster = {int(fraud)} AS DOUBLE) AS prediction FROM __THIS__")
    return PipelineModel(stages=[*features.stages, *before, named, mapped])


def fallback_cluster(rates: DataFrame, fallback: str = "first") -> int:
    """The cluster taken for fraud where none reaches the majority rate:
    ``first`` is cluster 0, as the original job has it, ``highest`` the one with
    the highest rate (lowest id on ties)."""
    if fallback == "first":
        return 0
    if fallback != "highest":
        raise ValueError("fallback is first or highest")
    found = rates.agg(F.max_by("prediction", F.struct("rate", (-F.col("prediction")).alias("n"))).alias("c")).first()
    return int(found.c or 0)

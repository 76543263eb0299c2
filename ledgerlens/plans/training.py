"""The end-to-end training job as one set of lazy plans:

load -> balance (hash coin) -> split (complementary filters) -> fit features
-> fit each registered model -> score test -> fused metrics -> best by F1
-> save features+model as one artifact, metrics as JSON.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators import anomaly, boosting, evaluation as ev, features as feat, models
from ..operators.parallel import FITS_AT_ONCE, side_by_side
from ..sources import files
from .workbench import Workbench, workbench

BOOSTED = "GradientBoostedTrees"
ALL_MODELS = ("LogisticRegression", "RandomForest", "AnomalyDetector", BOOSTED)


def linear_weighted_pipeline() -> Pipeline:
    """The saved linear pipelines' shape: 8 numbers (with balance deltas) +
    one-hot type with an unseen slot, scaled, class-weighted binomial LR."""
    return models.full_pipeline(feat.feature_stages(wide=True), models.weighted_logistic_regression())


# Model registry: leaderboard name -> (workbench key, fit(workbench)).  The
# supervised models fit on the shared scaled features; the wide linear model
# carries its own feature stages; the anomaly detector is scored separately.
REGISTRY = {
    "LogisticRegression": ("lr", lambda wb: models.logistic_regression().fit(wb.train_features())),
    "RandomForest": ("rf", lambda wb: models.random_forest(seed=wb.seed).fit(wb.train_features())),
    BOOSTED: ("gbt", lambda wb: models.boosted_trees(seed=wb.seed).fit(wb.train_features())),
    "AnomalyDetector": ("anomaly", lambda wb: anomaly.fit_anomaly(wb.train_features(), seed=wb.seed)),
    "LinearWeighted": ("linear_weighted", lambda wb: linear_weighted_pipeline().fit(wb.wide_train())),
    # the scoring form's model: four fields, the type as its fixed code, zeros as missing values
    "FormBoosted": ("form_boosted", lambda wb: models.form_pipeline().fit(wb.train)),
    "SecondOrderBoosting": ("second_order", lambda wb: boosting.SecondOrderBoosting().fit(wb.train_features())),
}
if models.xgboost_available():
    REGISTRY["XGBoost"] = ("xgboost", lambda wb: models.boosted_trees(seed=wb.seed, engine="xgboost").fit(wb.train_features()))


def check_names(names) -> tuple[str, ...]:
    """The names, each known to the registry; raises before anything is fitted."""
    unknown = [n for n in names if n not in REGISTRY]
    if unknown or not names:
        raise ValueError(f"unknown models {unknown}; known: {sorted(REGISTRY)}")
    return tuple(names)


def fitted_model(wb: Workbench, name: str):
    check_names([name])
    key, fit = REGISTRY[name]
    return wb.fitted(key, lambda: fit(wb))


def fit_all(wb: Workbench, names: Sequence[str], at_once: int = FITS_AT_ONCE) -> list:
    """Every named model, fitted side by side on the shared persisted frames."""
    check_names(names)
    wb.train_features().count()          # made once, before the fits ask for it together
    return side_by_side(wb.spark, [(n, lambda n=n: fitted_model(wb, n)) for n in names], at_once)


def artifact(wb: Workbench, name: str) -> PipelineModel:
    """Everything that scoring new rows needs, as one pipeline: the features,
    the model and, for the cluster detector, the class of its clusters."""
    fitted = fitted_model(wb, name)
    if name == "LinearWeighted":      # carries its own features but for the deltas
        return PipelineModel(stages=[feat.balance_deltas_stage(), *fitted.stages])
    if name == "FormBoosted":
        return fitted
    if name == "AnomalyDetector":
        return anomaly.scoring_pipeline(wb.feature_model(), fitted, wb.train_features())
    return models.combine(wb.feature_model(), fitted)


def fit_predict(wb: Workbench, name: str, map_on: str = "train") -> DataFrame:
    """Fit (once per workbench) and score the test side.  ``map_on="test"``
    maps anomaly clusters with test labels, as the original job did."""
    m = fitted_model(wb, name)
    if name == "AnomalyDetector":
        test = wb.test_features()
        return anomaly.anomaly_predictions(m, test, test if map_on == "test" else wb.train_features())
    if name == "LinearWeighted":
        return m.transform(feat.with_balance_deltas(wb.test))
    if name == "FormBoosted":
        return m.transform(wb.test)
    return m.transform(wb.test_features())


def evaluate(spark: SparkSession, sf_dir: str, names=ALL_MODELS, seed: int = 42) -> DataFrame:
    """Wide metrics table (model, position, six metrics) for ``names``."""
    return metrics_of(workbench(spark, sf_dir, seed), names)


def metrics_of(wb: Workbench, names: Sequence[str]) -> DataFrame:
    """The metrics table of the named models: fitted side by side, measured in one
    pass, and kept by the workbench, so that picking the best reads it again."""
    names = check_names(names)

    def make() -> DataFrame:
        fit_all(wb, names)
        return wb.persist(ev.metrics_table([(n, fit_predict(wb, n)) for n in names]))
    return wb.memo(("metrics", names), make)


def run_job(spark: SparkSession, sf_dir: str, out_dir: str | None = None, names=ALL_MODELS,
            seed: int = 42) -> dict:
    """Train every model, pick the best by F1 over all models, save the best
    features+model pipeline and the metrics JSON under ``out_dir`` (a folder
    in the shared ``spark.checkpoint.dir`` by default)."""
    names = check_names(names)
    wb = workbench(spark, sf_dir, seed)
    wide = evaluate(spark, sf_dir, names, seed)
    best = ev.select_best(wide).first()
    out = out_dir or files.scratch_dir(spark, "job")
    best_name = best["best_model"] if best else None
    if best_name:
        models.save_model(artifact(wb, best_name), f"{out}/best_model")
    long = ev.to_long(wide.drop("position"))
    files.write_metrics_json(long, f"{out}/metrics")
    files.write_results_json(long, ev.select_best(wide), f"{out}/results")
    rows = wide.orderBy("position").collect()    # one row per model
    wb.close()
    return {"best_model": best_name, "out_dir": out,
            "all_metrics": {r["model"]: {k: r[k] for k in r.asDict() if k not in ("model", "position")}
                            for r in rows}}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """load -> balance -> split -> features + LR -> score -> fused metrics."""
    wb = workbench(spark, sf_dir)
    return ev.metrics_table([("LogisticRegression", fit_predict(wb, "LogisticRegression"))])

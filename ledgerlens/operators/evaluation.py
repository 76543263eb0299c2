"""Exact evaluation as fused aggregations, all models in one pass.

The predictions of every model are stacked into one narrow frame
(model number, label, prediction, score), so the number of Spark jobs does
not grow with the number of models.

* Confusion counts: conditional counts, taken along with the curve points.
* Accuracy / precision / recall / F1: guarded ratios over those counts.
* ROC-AUC and PR-AUC: exact (one curve point per distinct score, the same
  curve as ``BinaryClassificationEvaluator(numBins=0)``), computed without
  pulling scores into one task:

    1. group rows by (model, score) -> counts   [partial aggregation], written
       as a table in the shared folder
    2. cut each model's distinct scores into B ranges with a grouped
       ``percentile_approx`` (boundaries only balance the work; the result
       stays exact)
    3. cumulative counts inside each range with a window partitioned by range
    4. add the counts of all higher ranges of the model from a table of at
       most B rows a model, broadcast with that bound
    5. sum the trapezoids.

  A hot score value (e.g. a third of all rows sharing one score) collapses
  to one row in step 1, so no range is skewed by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import guarded_ratio, score_of
from ..sources import files
from ..sources.schema import LABEL, METRIC_NAMES
from .joins import join_small


# --------------------------------------------------------------------- E1, E2
def confusion(pred: DataFrame, label: str = LABEL, prediction: str = "prediction",
              by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    aggs = [
        F.count_if((y == 1.0) & (p == 1.0)).alias("tp"),
        F.count_if((y == 0.0) & (p == 0.0)).alias("tn"),
        F.count_if((y == 0.0) & (p == 1.0)).alias("fp"),
        F.count_if((y == 1.0) & (p == 0.0)).alias("fn"),
    ]
    return pred.groupBy(*by).agg(*aggs) if by else pred.agg(*aggs)


def prf_columns() -> list[Column]:
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    precision = guarded_ratio(tp, tp + fp)
    recall = guarded_ratio(tp, tp + fn)
    f1 = guarded_ratio(F.lit(2.0) * precision * recall, precision + recall)
    accuracy = guarded_ratio(tp + tn, tp + tn + fp + fn, default=None)  # NULL on empty input
    return [accuracy.alias("Accuracy"), precision.alias("Precision"),
            recall.alias("Recall"), f1.alias("F1")]


def prf(conf: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return conf.select(*keep, "tp", "tn", "fp", "fn", *prf_columns())


# --------------------------------------------------------------------- E3, E4
def _default_buckets(spark: SparkSession) -> int:
    """One score range per shuffle partition."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def stacked(preds: Sequence[DataFrame], label: str = LABEL, prediction: str = "prediction",
            score: Column | None = None) -> DataFrame:
    """The models' predictions one under the other: (position, y, p, s).  Rows
    whose label is neither 0 nor 1 count nowhere and are left out; a model without
    a score column has NULL scores, and NaN scores are NULL."""
    parts = []
    for position, pred in enumerate(preds):
        s = score if score is not None else score_of(pred.schema) if "rawPrediction" in pred.columns else F.lit(None)
        p = F.col(prediction) if prediction in pred.columns else F.lit(None)
        parts.append(pred.select(F.lit(position).alias("position"), F.col(label).cast("double").alias("y"),
                                 p.cast("double").alias("p"), s.cast("double").alias("s")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.filter(F.col("y").isin(0.0, 1.0)).withColumn("s", F.when(~F.isnan("s"), F.col("s")))


def score_points(frame: DataFrame) -> DataFrame:
    """One row per model and distinct score: its positive (label 1) and negative
    (label 0) counts, and the confusion counts of its rows.  Rows without a
    score are counted in ``unscored`` on a row with a NULL score."""
    y, p, scored = F.col("y"), F.col("p"), F.col("s").isNotNull()
    return frame.groupBy("position", "s").agg(
        F.count_if((y == 1.0) & scored).alias("pos"), F.count_if((y == 0.0) & scored).alias("neg"),
        F.count_if(~scored).alias("unscored"),
        F.count_if((y == 1.0) & (p == 1.0)).alias("n_tp"), F.count_if((y == 0.0) & (p == 0.0)).alias("n_tn"),
        F.count_if((y == 0.0) & (p == 1.0)).alias("n_fp"), F.count_if((y == 1.0) & (p == 0.0)).alias("n_fn"))


POINTS = "position int, s double, pos long, neg long, unscored long, n_tp long, n_tn long, n_fp long, n_fn long"


def _range_of(score: str, bounds: Column, b: int) -> Column:
    """Number of the sorted ``bounds`` below ``score``, in steps of halving size."""
    steps = F.array(*[F.lit(1 << i) for i in range(max(1, b).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(bounds)) & (F.get(bounds, at + step - 1) < F.col(score)), at + step).otherwise(at))


def curves(preds: Sequence[DataFrame], label: str = LABEL, prediction: str = "prediction", score: Column | None = None,
           buckets: int | None = None) -> DataFrame:
    """One row per model (position): tp, tn, fp, fn, roc_auc, pr_auc, n_pos, n_neg,
    n_unscored.  AUCs are over the scored rows, NULL where one class or both are missing."""
    spark, models = preds[0].sparkSession, len(preds)
    b = buckets or _default_buckets(spark)
    # the points are read three times; as a table they are made once
    path = files.scratch_dir(spark, "curve-points")
    score_points(stacked(preds, label, prediction, score)).write.parquet(path)
    pts = spark.read.schema(POINTS).parquet(path)
    none = [(i, None, *[0] * 7) for i in range(models)]                 # a model without rows has its row, too
    pts = pts.unionByName(spark.createDataFrame(none, POINTS))

    # a range is numbered over all models, and grows with the score inside one
    rid = F.col("position") * b
    if b > 1:
        probs = [i / b for i in range(1, b)]
        bounds = pts.groupBy("position").agg(F.percentile_approx("s", probs, 10000).alias("bounds"))
        pts = join_small(pts, bounds, "position", "left", small_rows=models)
        pts = pts.withColumn("rid", rid + _range_of("s", F.col("bounds"), b)).drop("bounds")
    else:
        pts = pts.withColumn("rid", rid)

    totals = pts.groupBy("position", "rid").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    # positives/negatives in all ranges of the model above this one (scores are
    # ranked descending): a window over at most B rows a model, never over points
    higher = Window.partitionBy("position").orderBy(F.col("rid").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "rid",
        F.coalesce(F.sum("bp").over(higher), F.lit(0)).alias("op"),
        F.coalesce(F.sum("bn").over(higher), F.lit(0)).alias("on"),
    )
    inside = Window.partitionBy("rid").orderBy(F.col("s").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # every range has an offsets row, so a left join equals the inner join;
    # unlike it, it infers no extra filter on the points side, which lets the
    # points exchange be reused by the totals branch instead of recomputed
    counts = ("n_tp", "n_tn", "n_fp", "n_fn", "unscored")
    cum = (join_small(pts, offsets, "rid", "left", small_rows=b * models)
              .select("position", "pos", "neg", *counts,
                      (F.col("op") + F.sum("pos").over(inside)).alias("tp"),
                      (F.col("on") + F.sum("neg").over(inside)).alias("fp")))

    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    prev_tp, prev_fp = tp - pos, fp - neg
    # the row of the unscored comes last and adds no counts; where nothing is scored there is nothing to divide by
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    prev_prec = F.when(prev_tp + prev_fp == 0, prec).otherwise(prev_tp / (prev_tp + prev_fp))
    sums = cum.groupBy("position").agg(
        F.sum(neg * (F.lit(2.0) * tp - pos)).alias("roc_num"),
        F.sum(pos * (prec + prev_prec)).alias("pr_num"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum("unscored").alias("n_unscored"),
        *[F.sum(c).alias(c) for c in counts[:4]])
    P, N = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    valid = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    whole = {"tp": "n_tp", "tn": "n_tn", "fp": "n_fp", "fn": "n_fn", "n_pos": "n_pos", "n_neg": "n_neg", "n_unscored": "n_unscored"}
    return sums.select(
        "position",
        F.when(valid, F.col("roc_num") / (F.lit(2.0) * P * N)).alias("roc_auc"),
        F.when(valid, F.col("pr_num") / (F.lit(2.0) * P)).alias("pr_auc"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(name) for name, c in whole.items()])


def auc_exact(pred: DataFrame, score: Column | None = None, label: str = LABEL,
              buckets: int | None = None) -> DataFrame:
    """One row (roc_auc, pr_auc, n_pos, n_neg, n_unscored) for one model."""
    return curves([pred], label, score=score, buckets=buckets).select("roc_auc", "pr_auc", "n_pos", "n_neg", "n_unscored")


def auc_evaluator(pred: DataFrame, label: str = LABEL, raw: str = "rawPrediction",
                  metric: str = "areaUnderROC", bins: int = 0) -> float:
    """The Spark ML evaluator.  ``bins=0`` is the exact curve; ``bins=1000``, the
    evaluator's default, merges neighbouring scores into about as many points."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw,
                                       metricName=metric, numBins=bins)
    return ev.evaluate(pred)


# --------------------------------------------------------------------- E5-E7
def metrics_table(preds: Sequence[tuple[str, DataFrame]], label: str = LABEL, prediction: str = "prediction",
                  score: Column | None = None, buckets: int | None = None) -> DataFrame:
    """(model, position, six metrics) for a list of (name, predictions): one row
    per model, from one set of passes over all of them.  AUCs are NULL when the
    predictions carry no score column."""
    found = curves([p for _, p in preds], label, prediction, score, buckets)
    names = F.array(*[F.lit(name) for name, _ in preds])
    return found.select(F.get(names, F.col("position")).alias("model"), "position", *prf_columns(),
                        F.col("roc_auc").alias("ROC-AUC"), F.col("pr_auc").alias("PR-AUC"))


def to_long(wide: DataFrame, id_cols: Sequence[str] = ("model",),
            metrics: Sequence[str] = METRIC_NAMES) -> DataFrame:
    return wide.unpivot(list(id_cols), list(metrics), "metric", "value")


def metrics_long(preds: Sequence[tuple[str, DataFrame]], **kw) -> DataFrame:
    """(model, position, metric, value) for a list of (name, predictions)."""
    return to_long(metrics_table(preds, **kw), ("model", "position"))


def metrics_wide(long: DataFrame, id_cols: Sequence[str] = ("model", "position")) -> DataFrame:
    """model x metric matrix; the pivot values are the fixed metric names, so
    no extra job discovers them."""
    return long.groupBy(*id_cols).pivot("metric", METRIC_NAMES).agg(F.first("value"))


def summary_lines(long: DataFrame, digits: int = 9) -> DataFrame:
    """The printed summary as rows: ``model:`` headers and ``  metric: value``
    lines (``None`` for a missing AUC), with their order as columns
    (position, line_no) instead of relying on row order."""
    # format_string renders a NULL argument as "null", so NULL is handled first
    value = F.when(F.col("value").isNull(), F.lit("None")).otherwise(
        F.format_string(f"%.{digits}f", F.col("value").cast("double")))
    metric_no = F.lit(0)
    for i, m in enumerate(METRIC_NAMES):
        metric_no = F.when(F.col("metric") == m, F.lit(i + 1)).otherwise(metric_no)
    lines = long.select("model", "position", metric_no.alias("line_no"),
                        F.concat(F.lit("  "), F.col("metric"), F.lit(": "), value).alias("line"))
    heads = long.select("model", "position").distinct().select(
        "model", "position", F.lit(0).alias("line_no"), F.concat(F.col("model"), F.lit(":")).alias("line"))
    return heads.unionByName(lines)


def select_best(wide: DataFrame, metric: str = "F1", position: str = "position") -> DataFrame:
    """Best model by ``metric`` (strictly greater wins; earlier position wins
    ties) as one global aggregate -- no sort."""
    key = F.struct(F.col(f"`{metric}`"), (-F.col(position)).alias("neg_pos"))
    return wide.filter(F.col(f"`{metric}`").isNotNull()).agg(
        F.max_by("model", key).alias("best_model"),
        F.max(F.col(f"`{metric}`")).alias(f"best_{metric.replace('-', '_')}"))

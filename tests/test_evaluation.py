import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import evaluation as ev


def _scored(spark, n=3000, ties=True, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = 1.0 if rnd.random() < 0.3 else 0.0
        s = rnd.gauss(1.0 if y else 0.0, 1.0)
        rows.append((i, y, round(s, 1) if ties else s))
    return spark.createDataFrame(rows, "id long, isFraud double, rawPrediction double")


@pytest.mark.parametrize("ties", [True, False])
@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_exact_auc_equals_evaluator_without_bins(spark, ties, buckets):
    df = _scored(spark, ties=ties)
    r = ev.auc_exact(df, buckets=buckets).first()
    assert r.roc_auc == pytest.approx(ev.auc_evaluator(df), abs=1e-12)
    assert r.pr_auc == pytest.approx(ev.auc_evaluator(df, metric="areaUnderPR"), abs=1e-12)


def test_auc_vector_raw_prediction_uses_element_one(spark, wb):
    from ledgerlens.operators import models

    m = models.logistic_regression().fit(wb.train_features())
    pred = m.transform(wb.test_features())
    r = ev.auc_exact(pred).first()
    assert r.roc_auc == pytest.approx(ev.auc_evaluator(pred), abs=1e-12)


def test_auc_single_class_and_empty_are_null(spark):
    one = spark.createDataFrame([(1.0, 0.3), (1.0, 0.5)], "isFraud double, rawPrediction double")
    r = ev.auc_exact(one).first()
    assert r.roc_auc is None and r.pr_auc is None and r.n_pos == 2
    r = ev.auc_exact(one.limit(0)).first()
    assert r.roc_auc is None and (r.n_pos, r.n_neg) == (0, 0)


def test_all_equal_scores_give_half(spark):
    df = spark.createDataFrame([(1.0, 0.5), (0.0, 0.5), (0.0, 0.5)], "isFraud double, rawPrediction double")
    assert ev.auc_exact(df).first().roc_auc == pytest.approx(0.5)


def test_confusion_and_guarded_ratios(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 1.0), (0.0, 0.0)],
                               "isFraud double, prediction double")
    r = ev.prf(ev.confusion(df)).first()
    assert (r.tp, r.tn, r.fp, r.fn) == (1, 2, 1, 1)
    assert (r.Accuracy, r.Precision, r.Recall, r.F1) == (0.6, 0.5, 0.5, 0.5)
    e = ev.prf(ev.confusion(df.limit(0))).first()
    assert e.Accuracy is None and (e.Precision, e.Recall, e.F1) == (0.0, 0.0, 0.0)


def test_metrics_long_wide_and_best_first_wins_ties(spark):
    a = spark.createDataFrame([(1.0, 1.0, 0.9), (0.0, 0.0, 0.1)], "isFraud double, prediction double, rawPrediction double")
    long = ev.metrics_long([("first", a), ("second", a)])
    assert long.count() == 12
    wide = ev.metrics_wide(long)
    assert set(wide.columns) == {"model", "position", "Accuracy", "Precision", "Recall", "F1", "ROC-AUC", "PR-AUC"}
    best = ev.select_best(wide).first()
    assert best.best_model == "first" and best.best_F1 == 1.0


def test_metrics_without_score_have_null_auc(spark):
    a = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0)], "isFraud double, prediction double")
    wide = ev.metrics_wide(ev.metrics_long([("m", a)])).first()
    assert wide["ROC-AUC"] is None and wide["F1"] == 1.0


# Published ratio metrics and the integer confusion matrices
PUBLISHED = {
    "LogisticRegression": ((1159, 32, 470, 4990),
                           (0.9245226281762141, 0.9731318219983207, 0.7114794352363413, 0.8219858156028369)),
    "RandomForest": ((1571, 57, 58, 4965),
                     (0.9827093670124794, 0.964987714987715, 0.9643953345610804, 0.9646914338348174)),
    "AnomalyDetector": ((1629, 3301, 0, 1721),
                        (0.5036836565929935, 0.3304259634888438, 1.0, 0.49672206128983076)),
    "XGBoost": ((1617, 43, 12, 4979),
                (0.9917305668320553, 0.9740963855421687, 0.992633517495396, 0.9832775919732442)),
}


@pytest.mark.parametrize("name", sorted(PUBLISHED))
def test_published_metrics_reproduce_bit_for_bit(spark, name):
    """Our fused confusion + guarded ratios give the published numbers exactly."""
    (tp, fp, fn, tn), published = PUBLISHED[name]
    rows = [(1.0, 1.0)] * tp + [(0.0, 1.0)] * fp + [(1.0, 0.0)] * fn + [(0.0, 0.0)] * tn
    df = spark.createDataFrame(rows, "isFraud double, prediction double")
    got = ev.prf(ev.confusion(df)).first()
    assert (got.Accuracy, got.Precision, got.Recall, got.F1) == published


def test_auc_points_window_is_partitioned_by_range(spark):
    import re

    df = _scored(spark)
    plan = ev.auc_exact(df, buckets=8)._jdf.queryExecution().executedPlan().toString()
    # cumulative counts over points run per score range, never in one task
    assert re.search(r"Window \[.*\], \[rid#\d+\], \[s#\d+ DESC", plan)
    assert F is not None


def test_rule_metrics_do_not_depend_on_partitioning(spark, wb):
    from ledgerlens.plans import catalog

    results = []
    for n in (1, 4, 8):
        test = wb.test.repartition(n)
        pred = catalog._rule_scored(test)
        long = ev.metrics_long([("AmountRule", pred)], score=F.col("score"))
        results.append(sorted((r.metric, r.value) for r in long.collect()))
    assert results[0] == results[1] == results[2]


def test_summary_lines_show_missing_auc_as_none(spark):
    a = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0)], "isFraud double, prediction double")
    rows = ev.summary_lines(ev.metrics_long([("m", a)])).orderBy("position", "line_no").collect()
    assert [r.line for r in rows] == ["m:", "  Accuracy: 1.000000000", "  Precision: 1.000000000",
                                      "  Recall: 1.000000000", "  F1: 1.000000000", "  ROC-AUC: None",
                                      "  PR-AUC: None"]


def test_unscored_rows_are_counted_and_one_label_rule_holds(spark):
    rows = [(1.0, 0.9), (0.0, 0.2), (1.0, None), (0.0, float("nan")), (2.0, 0.1), (None, 0.5)]
    df = spark.createDataFrame(rows, "isFraud double, rawPrediction double")
    for buckets in (1, 4):
        r = ev.auc_exact(df, buckets=buckets).first()
        assert (r.roc_auc, r.n_pos, r.n_neg, r.n_unscored) == (1.0, 1, 1, 2)
    none = ev.auc_exact(df.filter("rawPrediction is null")).first()
    assert (none.roc_auc, none.n_unscored) == (None, 1)

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlens.operators import anomaly, evaluation as ev, models, scoring
from ledgerlens.plans import catalog
from ledgerlens.sources import files
from ledgerlens.streaming import scoring_stream


def test_lr_score_equations_hold_at_convergence(wb):
    m = models.logistic_regression(max_iter=200, tol=1e-12).fit(wb.train_features())
    pred = m.transform(wb.train_features())
    rows = pred.select(vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p"),
                       "isFraud").collect()
    x = np.array([r.x for r in rows])
    g = np.array([r.p - r.isFraud for r in rows])
    assert abs(g.sum()) < 1e-3 * len(rows)                     # intercept equation
    assert np.all(np.abs(x.T @ g) < 1e-2 * len(rows))


@pytest.mark.parametrize("name", ["LogisticRegression", "RandomForest"])
def test_full_models_beat_a_constant_scorer(wb, name):
    from ledgerlens.plans.training import fit_predict

    auc = ev.auc_exact(fit_predict(wb, name)).first().roc_auc
    assert auc > 0.9


def test_anomaly_detector_beats_a_coin(wb):
    pred = anomaly.anomaly_predictions(anomaly_model(wb), wb.test_features(), wb.train_features(), fallback="highest")
    assert set(pred.select("prediction").distinct().toPandas().prediction) <= {0, 1}
    assert ev.auc_exact(pred).first().roc_auc > 0.5


def anomaly_model(wb):
    from ledgerlens.plans.training import fitted_model

    return fitted_model(wb, "AnomalyDetector")


def test_fits_do_not_depend_on_the_input_layout(spark, wb):
    from ledgerlens.plans.training import fit_predict
    from ledgerlens.plans.workbench import Workbench

    other = Workbench(spark, None, wb.seed, txn=wb.txn.repartition(7, "amount"))
    for name in ("RandomForest", "AnomalyDetector"):
        a, b = (fit_predict(w, name).select("txn_id", "prediction") for w in (wb, other))
        assert a.exceptAll(b).count() == 0, name
    other.close()


def test_pick_majority_group_fallback_and_ties(spark):
    none_ok = spark.createDataFrame([(0, 0.2), (1, 0.4)], "prediction int, rate double")
    assert anomaly.pick_majority_group(none_ok).first().fraud_cluster == 0
    two_ok = spark.createDataFrame([(0, 0.6), (1, 0.9), (2, 0.9)], "prediction int, rate double")
    assert anomaly.pick_majority_group(two_ok).first().fraud_cluster == 1


def test_distance_expression_matches_numpy(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([0.0, -1.0, 5.5],)], "v array<double>")
    centre = [0.5, 0.5, 0.5]
    got = [r.d for r in df.select(anomaly.distance_score(F.col("v"), centre).alias("d")).collect()]
    want = [-float(np.sum((np.array(v) - np.array(centre)) ** 2)) for v in ([1.0, 2.0, 3.0], [0.0, -1.0, 5.5])]
    assert got == pytest.approx(want)


def test_saved_pipeline_scores_identically_after_reload(spark, wb):
    fitted = models.full_pipeline(__import__("ledgerlens.operators.features", fromlist=["x"]).feature_stages(),
                                  models.logistic_regression()).fit(wb.train)
    path = files.scratch_dir(spark, "test-model")
    models.save_model(fitted, path)
    before = scoring.score_batch(fitted, wb.test, digits=9)
    after = scoring.score_batch(models.load_model(path), wb.test, digits=9)
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0


def test_stream_equals_batch(spark, wb):
    stream = catalog.score_stream(spark, wb.sf_dir)
    batch = catalog.score_batch_linear(spark, wb.sf_dir)
    assert stream.count() == batch.count() == wb.test.count()
    assert stream.exceptAll(batch.select(*stream.columns)).count() == 0


def test_stream_resumes_from_checkpoint(spark, wb):
    """A second availableNow run over the same checkpoint adds nothing."""
    model = catalog._saturated_lr(wb)
    base = files.scratch_dir(spark, "test-stream")
    src, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ck"
    wb.test.select("txn_id", "type", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest",
                   "newbalanceDest").write.parquet(src)
    schema = spark.read.parquet(src).schema
    scoring_stream.drain_to_sink(scoring_stream.scored_stream(spark, model, src, schema), sink, ckpt)
    n1 = spark.read.parquet(sink).count()
    scoring_stream.drain_to_sink(scoring_stream.scored_stream(spark, model, src, schema), sink, ckpt)
    assert spark.read.parquet(sink).count() == n1 == wb.test.count()


def test_gbt_engine_defaults_to_spark_gbt():
    from pyspark.ml.classification import GBTClassifier

    assert isinstance(models.boosted_trees(), GBTClassifier)
    m = models.boosted_trees()
    assert (m.getMaxIter(), m.getMaxDepth(), m.getStepSize()) == (50, 6, 0.1)


def test_wide_weighted_linear_beats_constant(wb):
    from ledgerlens.plans.training import fit_predict

    pred = fit_predict(wb, "LinearWeighted")
    assert ev.auc_exact(pred).first().roc_auc > 0.9


def test_run_job_writes_best_model_and_results(spark, wb):
    from ledgerlens.plans.training import run_job

    out = run_job(spark, wb.sf_dir, names=("LogisticRegression", "RandomForest"))
    assert out["best_model"] in ("LogisticRegression", "RandomForest")
    f1 = {k: v["F1"] for k, v in out["all_metrics"].items()}
    assert f1[out["best_model"]] == max(f1.values())
    back = files.read_results_json(spark, out["out_dir"] + "/results").first()
    assert back.best_model == out["best_model"]
    assert set(back.all_metrics) == {"LogisticRegression", "RandomForest"}
    reloaded = models.load_model(out["out_dir"] + "/best_model")
    assert scoring.score_batch(reloaded, wb.test).count() == wb.test.count()


def test_top_reasons_positive_only_ties_by_name(spark):
    from ledgerlens.operators import explain

    df = spark.createDataFrame([(3.0, 1.0, 3.0, -2.0, 0.5)], "a double, b double, c double, d double, e double")
    r = df.select(explain.top_reasons({k: F.col(k) for k in "abcde"}, 3).alias("r")).first().r
    assert r == ["a", "c", "b"]
    none = df.select(explain.top_reasons({"d": F.col("d")}, 3).alias("r")).first().r
    assert none == []


def test_next_action_bands(spark):
    from ledgerlens.operators import explain

    df = spark.createDataFrame([(0.95,), (0.7,), (0.51,), (0.5,), (None,)], "p double")
    got = [r.a for r in df.select(explain.next_action("p").alias("a")).collect()]
    assert got == ["hold transaction", "ask customer", "investigate account", "no action", "no action"]


def test_stream_drains_backlog_in_bounded_batches(spark, wb):
    model = catalog._saturated_lr(wb)
    base = files.scratch_dir(spark, "test-stream-batches")
    src, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ck"
    cols = ["txn_id", "type", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
    wb.test.select(*cols).repartition(4).write.parquet(src)          # four files
    schema = spark.read.parquet(src).schema
    stream = scoring_stream.scored_stream(spark, model, src, schema, digits=4, max_files_per_trigger=1)
    q = scoring_stream.drain_to_sink(stream, sink, ckpt)
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 4
    out = spark.read.parquet(sink)
    batch = scoring.score_batch(model, wb.test.select(*cols), digits=4)
    assert out.count() == batch.count()
    out = out.drop("outcome", "given")
    assert out.exceptAll(batch.select(*out.columns)).count() == 0


def test_text_formatting_keeps_null(spark):
    from ledgerlens.functions.exprs import fixed4
    from ledgerlens.operators import explain

    df = spark.createDataFrame([(None, "PAYMENT", 1)], "amount double, type string, prediction int")
    assert df.select(fixed4("amount").alias("t")).first().t is None
    det = df.select(explain.transaction_details(["type", "amount"]).alias("d")).first().d
    assert det == "{type: PAYMENT, amount: null, predicted_label: 1}"


def test_every_row_leaves_the_stream(spark, wb):
    """Rows that can't be scored come out of the same pass with null scores, and as they came."""
    model = catalog._saturated_lr(wb)
    base = files.scratch_dir(spark, "test-stream-bad")
    cols = ["txn_id", "type", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
    good = wb.test.select(*cols)
    bad = spark.createDataFrame([(-1, "BARTER", 1.0, 1.0, 1.0, 1.0, 1.0), (-2, None, 1.0, 1.0, 1.0, 1.0, 1.0)], good.schema)
    good.unionByName(bad).write.parquet(f"{base}/in")
    out = scoring_stream.score_stream(spark, model, f"{base}/in", f"{base}/out", f"{base}/ck", good.schema)
    assert out.count() == good.count() + 2
    odd = {r.txn_id: r for r in out.filter("txn_id < 0").collect()}
    assert set(odd) == {-1, -2} and all(r.probability is None and r.prediction is None for r in odd.values())
    assert out.filter("txn_id >= 0 and probability is null").count() == 0
    kept = scoring_stream.rejected_rows(spark, f"{base}/out", good.schema)
    assert kept.exceptAll(bad).count() == 0 and bad.exceptAll(kept).count() == 0
    again = scoring_stream.score_stream(spark, model, f"{base}/in", f"{base}/out", f"{base}/ck", good.schema)
    assert again.count() == good.count() + 2


def test_batch_scoring_returns_every_row(spark, wb):
    from ledgerlens.operators import features as feat

    fitted = models.full_pipeline(feat.feature_stages(), models.logistic_regression()).fit(wb.train)
    cols = ["txn_id", "type", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
    good = wb.test.select(*cols)
    bad = spark.createDataFrame([(-1, "BARTER", 1.0, 1.0, 1.0, 1.0, 1.0), (-2, "DEBIT", None, 1.0, 1.0, 1.0, 1.0)], good.schema)
    out = scoring.score_batch(fitted, good.unionByName(bad), keep=("txn_id", "type", "amount"))
    odd = {r.txn_id: r for r in out.filter("txn_id < 0").collect()}
    assert (odd[-1].type, odd[-2].amount) == ("BARTER", None) and all(r.probability is None for r in odd.values())
    plain = scoring.scored_columns(fitted.transform(good), keep=("txn_id", "type", "amount"))
    assert out.filter("txn_id >= 0").exceptAll(plain).count() == 0


def test_detector_keeps_the_cheapest_of_its_starts(wb):
    """Never worse than any single start, and better than a coin at every size."""
    points = wb.train_features()
    many = anomaly.fit_anomaly(points, seed=wb.seed)
    singles = [anomaly.fit_anomaly(points, seed=wb.seed + i, starts=1).stages[-1].summary.trainingCost for i in range(anomaly.STARTS)]
    assert many.stages[-1].summary.trainingCost <= min(singles) * (1 + 1e-9)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_detector_beats_a_coin_at_every_size(spark, sf):
    from ledgerlens.plans.training import fitted_model
    from ledgerlens.plans.workbench import workbench

    other = workbench(spark, sf)
    pred = anomaly.anomaly_predictions(fitted_model(other, "AnomalyDetector"), other.test_features(), other.train_features(), fallback="highest")
    assert ev.auc_exact(pred).first().roc_auc > 0.5

"""Fits side by side, metrics kept, layouts."""
import pytest

from ledgerlens.operators import boosting, evaluation as ev, models
from ledgerlens.operators.parallel import side_by_side
from ledgerlens.plans import training
from ledgerlens.plans.workbench import ROWS_PER_PARTITION, Workbench, layout


def test_tasks_keep_order_properties_and_errors(spark):
    sc = spark.sparkContext
    sc.setLocalProperty("ledgerlens.mark", "own")
    seen = side_by_side(spark, [(f"t{i}", lambda i=i: (i, sc.getLocalProperty("ledgerlens.mark"), sc.getLocalProperty("spark.scheduler.pool")))
                                for i in range(6)], at_once=3)
    assert seen == [(i, "own", f"fit-t{i}") for i in range(6)]
    assert sc.getLocalProperty("spark.scheduler.pool") is None

    def fail():
        raise ValueError("first")
    with pytest.raises(ValueError, match="first"):
        side_by_side(spark, [("a", fail), ("b", lambda: 1)])


def test_tasks_run_at_the_same_time(spark):
    import threading

    met = threading.Barrier(3)

    def wait():
        met.wait(timeout=600)            # only if all three are running
        return spark.range(2).count()
    assert side_by_side(spark, [(str(i), wait) for i in range(3)]) == [2] * 3


def test_metrics_are_kept_and_take_few_jobs(spark, wb):
    names = ("LogisticRegression", "RandomForest")
    training.metrics_of(wb, names).collect()
    sc = spark.sparkContext
    sc.setJobGroup("metrics-again", "metrics-again")
    assert ev.select_best(training.metrics_of(wb, names)).first().best_model in names
    assert len(sc.statusTracker().getJobIdsForGroup("metrics-again")) <= 3
    sc.setJobGroup("metrics-one-pass", "metrics-one-pass")
    preds = [(n, training.fit_predict(wb, n)) for n in names]
    ev.metrics_table(preds).collect()
    assert len(sc.statusTracker().getJobIdsForGroup("metrics-one-pass")) < 12
    sc.setJobGroup("idle", "idle")


def test_layout_follows_the_rows():
    assert layout(0) == layout(16 * ROWS_PER_PARTITION) == 16
    assert layout(16 * ROWS_PER_PARTITION + 1) == 32 and layout(10 ** 9) == 4096


def test_predictions_do_not_depend_on_the_number_of_partitions(spark, wb):
    """All but the forest, whose bagging Spark seeds by partition."""
    found = []
    for n in (16, 64, 200):
        other = Workbench(spark, None, wb.seed, txn=wb.txn, train_partitions=n)
        rows = other.train_features()
        assert other.balanced.rdd.getNumPartitions() == n
        lr = models.logistic_regression().fit(rows)
        trees = boosting.SecondOrderBoosting(rounds=1, maxDepth=2).fit(rows)
        found.append([{r.txn_id: r.prediction for r in m.transform(other.test_features()).select("txn_id", "prediction").collect()} for m in (lr, trees)])
        other.close()
    assert found[0] == found[1] == found[2]

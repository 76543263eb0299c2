"""Second-order boosting against a plain numpy version."""
import json
import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from ledgerlens.operators import boosting, models, scoring
from ledgerlens.sources import files


def made(seed, n):
    g = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = g.choice([0.0, 1.0, 2.0, 5.0, -3.0]), g.choice([0.0, float("nan"), 4.0, 7.0]), float(g.randint(0, 9))
        p = 1 / (1 + math.exp(-(a - (1.0 if b != b else b) / 2 + (2 if c == 0 else -1))))
        rows.append((i, a, b, c, 1.0 if g.random() < p else 0.0))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "txn_id long, a double, b double, c double, isFraud double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features", handleInvalid="keep").transform(df)


def plain(x, y, rounds, depth, step=0.3, l2=1.0, least=1.0):
    """Margins of the rows, split by split."""
    missing = np.isnan(x) | (x == 0)
    margin = np.zeros(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        change = np.zeros(len(y))

        def grow(rows, d):
            best, most = None, boosting.LEAST_GAIN
            sg, sh = g[rows].sum(), h[rows].sum()
            for f in range(x.shape[1] if d else 0):
                values = np.unique(x[~missing[:, f], f])
                for cut in [*values[1:], np.inf]:
                    for to_left in ((True, False) if cut != np.inf else (False,)):
                        left = np.where(missing[rows, f], to_left, x[rows, f] < cut)
                        lg, lh = g[rows][left].sum(), h[rows][left].sum()
                        if lh < least or sh - lh < least:
                            continue
                        gain = 0.5 * (lg ** 2 / (lh + l2) + (sg - lg) ** 2 / (sh - lh + l2) - sg ** 2 / (sh + l2))
                        if gain > most + 1e-7:
                            best, most = left, gain
            if best is None:
                change[rows] = -step * sg / (sh + l2)
            else:
                grow(rows[best], d - 1)
                grow(rows[~best], d - 1)
        grow(np.arange(len(y)), depth)
        margin += change
    return margin


def probabilities(model, df):
    return {r.txn_id: r.p for r in model.transform(df).select("txn_id", vector_to_array("probability")[1].alias("p")).collect()}


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_equals_plain_boosting(spark, depth):
    rows = made(depth, 700)
    df = frame(spark, rows)
    model = boosting.SecondOrderBoosting(rounds=3, maxDepth=depth, stepSize=0.3).fit(df)
    want = plain(np.array([r[1:4] for r in rows]), np.array([r[4] for r in rows]), 3, depth)
    got = probabilities(model, df)
    assert np.allclose([got[r[0]] for r in rows], 1 / (1 + np.exp(-want)), atol=1e-6)


def test_splits_do_not_depend_on_the_layout(spark):
    df = frame(spark, made(7, 1200))
    fits = [boosting.SecondOrderBoosting(rounds=2, maxDepth=3).fit(df.repartition(n)).getOrDefault("trees") for n in (1, 7, 40)]
    assert fits[0] == fits[1] == fits[2]


def test_rounds_beyond_the_cut_and_odd_labels(spark, monkeypatch):
    rows = made(8, 400)
    df = frame(spark, rows)
    whole = boosting.SecondOrderBoosting(rounds=5, maxDepth=1).fit(df).getOrDefault("trees")
    monkeypatch.setattr(boosting, "CUT_ROUNDS", 2)
    odd = df.unionByName(frame(spark, [(9000, 1.0, 1.0, 1.0, 2.0), (9001, 1.0, 1.0, 1.0, None)]))
    cut = boosting.SecondOrderBoosting(rounds=5, maxDepth=1).fit(odd).getOrDefault("trees")
    a, b = json.loads(whole), json.loads(cut)
    assert [t["feature"] for t in a] == [t["feature"] for t in b] and np.allclose([t["value"] for t in a], [t["value"] for t in b], atol=1e-8)
    with pytest.raises(ValueError):
        boosting.SecondOrderBoosting(rounds=1).fit(df.limit(0))


def test_rounds_go_over_groups_of_equal_bins_and_label(spark, monkeypatch):
    rows = made(9, 600)
    df = frame(spark, rows)
    tables, table = [], boosting.SecondOrderBoosting._table
    monkeypatch.setattr(boosting.SecondOrderBoosting, "_table", staticmethod(lambda d: tables.append(table(d)) or tables[-1]))
    monkeypatch.setattr(boosting, "CUT_ROUNDS", 1)
    model = boosting.SecondOrderBoosting(rounds=2, maxDepth=2, stepSize=0.3).fit(df.unionByName(df).unionByName(df))
    groups = len({(*(0.0 if v != v else v for v in r[1:4]), r[4]) for r in rows})     # zeros and NaN are missing values
    assert groups < 600 and [t.count() for t in tables] == [groups, groups]
    assert [t.agg({"n": "sum"}).first()[0] for t in tables] == [1800, 1800]
    thrice = [r for r in rows for _ in range(3)]
    want = plain(np.array([r[1:4] for r in thrice]), np.array([r[4] for r in thrice]), 2, 2)
    got = probabilities(model, df)
    assert np.allclose([got[r[0]] for r in thrice], 1 / (1 + np.exp(-want)), atol=1e-6)


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(3000).selectExpr("id AS txn_id", "cast(id AS double) AS a", "0.0D AS b", "cast(id > 2000 AS double) AS isFraud")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = boosting.SecondOrderBoosting(rounds=3, maxDepth=2, maxBins=32).fit(df)
    wrong = model.transform(df).filter("prediction <> isFraud").count()
    assert wrong < 3000 / 32


def test_form_model_is_saved_and_scores_four_fields(spark, wb):
    model = models.form_pipeline(rounds=2, maxDepth=2).fit(wb.train)
    path = files.scratch_dir(spark, "test-form")
    models.save_model(model, path)
    back = PipelineModel.load(path)
    rows = wb.test.select("type", "amount", "oldbalanceOrg", "newbalanceOrig")
    a, b = (scoring.score_batch(m, rows, keep=("type", "amount")) for m in (model, back))
    assert a.count() == rows.count() and a.exceptAll(b).count() == 0
    odd = files.form_frame(spark, [("BARTER", 10.0, 0.0, 0.0), (None, None, None, None)])
    assert scoring.score_batch(back, odd, keep=("type",)).filter("probability is null").count() == 0     # missing values have a branch


def test_combined_artifact(spark, wb):
    fitted = boosting.SecondOrderBoosting(rounds=1, maxDepth=1).fit(wb.train_features())
    path = files.scratch_dir(spark, "test-combined")
    models.save_model(models.combine(wb.feature_model(), fitted), path)
    assert scoring.score_batch(models.load_model(path), wb.test).count() == wb.test.count()

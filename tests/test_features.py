import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import txn_rows
from ledgerlens.operators import features as feat


def test_string_index_order_frequency_then_alphabetical(spark):
    rows = [(1, "B", 1.0, 0.0), (2, "B", 1.0, 0.0), (3, "C", 1.0, 0.0), (4, "A", 1.0, 0.0), (5, "D", 1.0, 0.0),
            (6, "D", 1.0, 0.0)]
    m = StringIndexer(inputCol="type", outputCol="i").fit(txn_rows(spark, rows))
    assert m.labels == ["B", "D", "A", "C"]


def test_unseen_type_errors_or_is_kept(spark):
    train = txn_rows(spark, [(1, "A", 1.0, 0.0), (2, "B", 2.0, 1.0), (3, "B", 2.0, 1.0)])
    test = txn_rows(spark, [(4, "Z", 1.0, 0.0), (5, None, 1.0, 0.0)])
    strict = feat.fit_features(train)
    with pytest.raises(Exception):
        strict.transform(test).collect()
    keep = Pipeline(stages=feat.feature_stages(keep_invalid=True)[:2]).fit(train)
    out = keep.transform(test).select("type_index", vector_to_array("type_ohe").alias("v")).collect()
    assert [r.type_index for r in out] == [2.0, 2.0]          # unseen and NULL -> #labels
    assert all(len(r.v) == 3 and r.v[2] == 1.0 for r in out)  # width labels + 1, own slot


def test_one_hot_drop_last_width(spark, wb):
    fm = wb.feature_model()
    labels = fm.stages[0].labels
    assert labels == ["CASH_OUT", "TRANSFER", "PAYMENT", "CASH_IN", "DEBIT"]
    v = wb.test_features().select(vector_to_array("features_raw").alias("v")).first().v
    assert len(v) == 5 + len(labels) - 1


def test_null_number_errors_or_becomes_nan(spark):
    train = txn_rows(spark, [(1, "A", 1.0, 0.0), (2, "B", 2.0, 1.0)])
    bad = txn_rows(spark, [(3, "A", None, 0.0)])
    strict = Pipeline(stages=feat.feature_stages(scale=False, out="x")).fit(train)
    with pytest.raises(Exception):
        strict.transform(bad).collect()
    wide = Pipeline(stages=feat.feature_stages(wide=True, scale=False, out="x")).fit(feat.with_balance_deltas(train))
    v = wide.transform(feat.with_balance_deltas(bad)).select(vector_to_array("x").alias("v")).first().v
    assert v[0] != v[0]                                        # NaN


def test_scaler_divides_by_sample_std_fitted_on_train(wb):
    tr = wb.train_features().select(vector_to_array("features_raw").alias("r"), vector_to_array("features").alias("s"))
    sd = wb.train.agg(F.stddev_samp("amount").alias("sd")).first().sd
    r = tr.first()
    assert r.s[0] == pytest.approx(r.r[0] / sd, rel=1e-12)


def test_zero_variance_column_scales_to_zero(spark):
    df = txn_rows(spark, [(1, "A", 5.0, 0.0), (2, "A", 5.0, 1.0), (3, "B", 5.0, 1.0)])
    m = feat.fit_features(df)
    v = m.transform(df).select(vector_to_array("features").alias("v")).first().v
    assert v[0] == 0.0


def test_class_weights_balanced(wb):
    w = feat.with_class_weights(wb.train)
    tot = w.groupBy("isFraud").agg(F.sum("classWeightCol").alias("s")).collect()
    s = {r.isFraud: r.s for r in tot}
    assert s[0.0] == pytest.approx(s[1.0], rel=1e-9)          # each class carries n/2
    assert feat.class_weight_table(wb.train).count() == 2


def test_balance_deltas(spark):
    df = txn_rows(spark, [(1, "A", 50.0, 0.0)])                # 100 -> 50 origin, 10 -> 60 dest
    r = feat.with_balance_deltas(df).first()
    assert (r.deltaOrig, r.deltaDest, r.balanceMismatch) == (50.0, 50.0, 0.0)


def test_pca_sign_normalisation():
    assert feat.normalise_pca_signs([[0.2, -0.9], [0.5, 0.1]]) == [[-0.2, 0.9], [0.5, 0.1]]


def test_pca_transform_projects_without_centring(wb):
    import numpy as np

    model = feat.pca_stage(5).fit(wb.train_features())
    pc = model.pc.toArray()
    row = model.transform(wb.test_features()).select(
        vector_to_array("features").alias("x"), vector_to_array("pcaFeatures").alias("p")).first()
    assert np.allclose(np.array(row.x) @ pc, np.array(row.p), atol=1e-9)
    ev = model.explainedVariance.toArray()
    assert np.all(np.diff(ev) <= 1e-12) and ev.sum() <= 1.0 + 1e-9

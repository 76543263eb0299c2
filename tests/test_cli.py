"""The reference's usage: one labelled CSV in, best model + metrics out."""

import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.sources import files
from ledgerlens.sources.tables import txn_frame


def _write_csv(spark, path):
    txn = txn_frame(spark, SF_SMALL)
    # a CSV without any id column; label as integer text
    (txn.select(F.lit(1).alias("step"), "type", "amount", F.col("name_orig").cast("string").alias("nameOrig"),
                "oldbalanceOrg", "newbalanceOrig", F.col("name_dest").cast("string").alias("nameDest"),
                "oldbalanceDest", "newbalanceDest", F.col("isFraud").cast("int").alias("isFraud"))
        .coalesce(2).write.option("header", True).csv(path))


def test_labelled_csv_gets_content_key(spark, tmp_path):
    p = str(tmp_path / "tx")
    _write_csv(spark, p)
    df = files.read_labelled_csv(spark, p)
    assert dict(df.dtypes)["isFraud"] == "double" and "txn_id" in df.columns
    a = sorted(r.txn_id for r in df.select("txn_id").collect())
    b = sorted(r.txn_id for r in files.read_labelled_csv(spark, p).repartition(5).select("txn_id").collect())
    assert a == b                                       # key independent of partitioning


def test_cli_runs_the_job_on_a_csv(spark, tmp_path, capsys):
    from ledgerlens.__main__ import main

    p = str(tmp_path / "tx")
    _write_csv(spark, p)
    assert main(["--input", p, "--models", "LogisticRegression,RandomForest", "--out", str(tmp_path / "out")]) == 0
    out = json.loads(capsys.readouterr().out)
    assert out["best_model"] in ("LogisticRegression", "RandomForest")
    assert set(out["all_metrics"]) == {"LogisticRegression", "RandomForest"}
    back = files.read_results_json(spark, str(tmp_path / "out" / "results")).first()
    assert back.best_model == out["best_model"]
    # score the same file with the saved best pipeline (the dashboard's job)
    assert main(["--input", p, "--score-with", str(tmp_path / "out" / "best_model"),
                 "--out", str(tmp_path / "scored")]) == 0
    scored = spark.read.parquet(str(tmp_path / "scored"))
    assert scored.count() == 1500
    assert set(scored.columns) >= {"txn_id", "probability", "prediction", "label_text"}


def test_missing_required_column_is_reported(spark, tmp_path):
    import pytest

    p = tmp_path / "bad.csv"
    p.write_text("type,amount\nPAYMENT,1.0\n")
    with pytest.raises(ValueError, match="required"):
        files.read_labelled_csv(spark, str(p))


def test_payments_layout_reads_without_inference(spark, tmp_path):
    from ledgerlens.sources.schema import PAYMENTS_CSV_SCHEMA

    p = str(tmp_path / "tx")
    _write_csv(spark, p)
    df = files.read_labelled_csv(spark, p, PAYMENTS_CSV_SCHEMA)
    assert df.filter("isFraud = 1.0").count() == 89
    assert dict(df.dtypes)["nameDest"] == "string"
    sampled = files.read_labelled_csv(spark, p, sampling_ratio=0.5)
    assert sampled.count() == 1500


def test_default_command_line_and_every_artifact_scores(spark, tmp_path, capsys):
    import pytest

    from ledgerlens.__main__ import main
    from ledgerlens.operators import models, scoring
    from ledgerlens.plans import training
    from ledgerlens.plans.workbench import Workbench

    p = str(tmp_path / "tx")
    _write_csv(spark, p)
    assert main(["--input", p, "--out", str(tmp_path / "out"), "--train-partitions", "24"]) == 0
    out = json.loads(capsys.readouterr().out)
    assert tuple(out["all_metrics"]) == training.ALL_MODELS
    with pytest.raises(ValueError, match="unknown models"):
        main(["--input", p, "--models", "LogisticRegression,Nonsense"])
    df = files.read_labelled_csv(spark, p)
    wb = Workbench(spark, None, txn=df)
    for name in [n for n in training.REGISTRY if n not in ("SecondOrderBoosting", "FormBoosted")]:     # these: test_boosting.py
        made = training.artifact(wb, name)
        path = str(tmp_path / name)
        models.save_model(made, path)
        a = scoring.score_batch(made, df).select("txn_id", "probability", "prediction")
        b = scoring.score_batch(models.load_model(path), df).select("txn_id", "probability", "prediction")
        assert a.count() == 1500 and a.exceptAll(b).count() == 0
        own = {r.txn_id: int(r.prediction) for r in training.fit_predict(wb, name).select("txn_id", "prediction").collect()}
        saved = {r.txn_id: r.prediction for r in b.collect()}
        assert all(saved[k] == v for k, v in own.items()), name
    wb.close()


def test_threshold_is_on_the_raw_probability(spark):
    from pyspark.ml.linalg import Vectors

    from ledgerlens.operators import scoring

    df = spark.createDataFrame([(1, Vectors.dense(0.49997, 0.50003)), (2, Vectors.dense(0.5, 0.5))], ["txn_id", "probability"])
    got = {r.txn_id: (r.probability, r.prediction) for r in scoring.scored_columns(df, digits=4).collect()}
    assert got == {1: (0.5, 1), 2: (0.5, 0)}

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.sources import files
from ledgerlens.sources.schema import REQUEST_SCHEMA, TXN_SCHEMA
from ledgerlens.sources.tables import txn_frame


def test_txn_fixture_matches_published_counts(spark):
    txn = txn_frame(spark, SF_SMALL)
    r = txn.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("isFraud") == 1.0).alias("fraud"),
                F.count_if(F.col("name_dest").isNull()).alias("no_dest"),
                F.round(F.sum("newbalanceDest"), 2).alias("s")).first()
    assert (r.n, r.fraud, r.no_dest) == (1500, 89, 27)
    assert r.s == pytest.approx(12736011.90, abs=0.005)
    assert txn.select("txn_id").distinct().count() == 1500
    assert [f.name for f in txn.schema.fields] == [f.name for f in TXN_SCHEMA.fields]


def test_txn_scan_prunes_columns(spark):
    plan = txn_frame(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # lineitem is read for two columns only, never all eleven
    assert "l_shipdate" not in plan and "l_comment" not in plan


def test_missing_input_is_one_clear_error(spark, tmp_path):
    with pytest.raises(files.InputNotFound):
        files.read_parquet_checked(spark, str(tmp_path / "nope.parquet"))
    with pytest.raises(files.InputNotFound):
        files.read_txn_csv(spark, str(tmp_path / "nope.csv"))


def test_csv_label_try_cast(spark, tmp_path):
    p = tmp_path / "t.csv"
    header = ",".join(f.name for f in TXN_SCHEMA.fields)
    p.write_text(header + "\n1,1,2,PAYMENT,10.0,1,1,1,1,1\n2,1,2,PAYMENT,10.0,1,1,1,1,x\n"
                 "3,1,2,PAYMENT,10.0,1,1,1,1,\n4,1,2,PAYMENT,10.0,1,1,1,1,2\n")
    df = files.read_txn_csv(spark, str(p))
    got = {r.txn_id: r.isFraud for r in df.collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: 2.0}
    inferred = files.read_txn_csv(spark, str(p), infer=True)
    assert dict(inferred.dtypes)["isFraud"] == "double"


def test_request_frame_schema(spark):
    df = files.request_frame(spark, [(1, "PAYMENT", 10.0, 500.0, 490.0, 0.0, 10.0)])
    assert df.schema == REQUEST_SCHEMA


def test_metrics_json_roundtrip_nested(spark, tmp_path):
    import json

    p = tmp_path / "metrics_nested.json"
    p.write_text(json.dumps({"best_model": "m", "all_metrics": {"A": {"F1": 0.5, "ROC-AUC": None},
                                                                "B": {"F1": 0.7}}}))
    nested = spark.read.schema(files.NESTED_METRICS_SCHEMA).option("multiLine", True).json(str(p))
    long = {(r.model, r.metric): r.value for r in files.nested_metrics_to_long(nested).collect()}
    assert long == {("A", "F1"): 0.5, ("A", "ROC-AUC"): None, ("B", "F1"): 0.7}


def test_flat_metrics_json_keeps_explicit_null(spark, tmp_path):
    import glob

    from ledgerlens.operators import evaluation as ev

    a = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0)], "isFraud double, prediction double")
    long = ev.metrics_long([("m", a)]).drop("position")
    path = str(tmp_path / "flat")
    files.write_metrics_json(long, path)
    text = "".join(open(f).read() for f in glob.glob(path + "/part-*"))
    assert '"metric":"ROC-AUC","value":null' in text
    back = {(r.metric, r.value) for r in files.read_metrics_json(spark, path).collect()}
    assert ("ROC-AUC", None) in back and ("F1", 1.0) in back


def test_equal_rows_get_keys_and_places_of_their_own(spark):
    from pyspark.sql import functions as F

    from ledgerlens.sources import files

    rows = [("PAYMENT", 1.0)] * 3000 + [("DEBIT", float(i)) for i in range(1500)]
    df = spark.createDataFrame(rows, "type string, amount double")
    keyed = files.with_row_key(df)
    assert keyed.columns == ["type", "amount", "txn_id"]
    assert keyed.count() == 4500 == keyed.select("txn_id").distinct().count()
    sizes = [r["count"] for r in keyed.repartition(8, "txn_id").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * 4500 / 8
    a = {r.txn_id for r in keyed.collect()}
    assert a == {r.txn_id for r in files.with_row_key(df.repartition(5)).collect()}
    given = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "txn_id long, type string")
    assert files.with_row_key(given).select("txn_id").distinct().count() == 3


def test_rows_that_occur_once_are_keyed_in_place(spark):
    import re

    df = spark.range(0, 4000, 1, 6).selectExpr("id AS a", "id * 2 AS copies", "cast(id AS string) AS row_digest", "'x' AS _copies")
    keyed = files.with_row_key(df)
    assert keyed.count() == 4000 == keyed.select("txn_id").distinct().count()
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning", plan)       # nothing repeats: no row moves
    more = df.unionByName(df.limit(3)).unionByName(df.limit(3))
    keyed = files.with_row_key(more)
    assert keyed.count() == 4006 == keyed.select("txn_id").distinct().count()
    assert keyed.columns == ["a", "copies", "row_digest", "_copies", "txn_id"]
    assert {r.txn_id for r in keyed.collect()} == {r.txn_id for r in files.with_row_key(more.repartition(3)).collect()}


def test_form_frame_has_the_four_fields(spark):
    df = files.form_frame(spark, [("PAYMENT", 10.0, 500.0, 490.0)])
    assert df.columns == ["type", "amount", "oldbalanceOrg", "newbalanceOrig"] and df.count() == 1

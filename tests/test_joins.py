from ledgerlens.operators.joins import join_small


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_with_a_proven_bound(spark):
    big = spark.range(0, 5000).withColumnRenamed("id", "k")
    small = spark.range(0, 3).withColumnRenamed("id", "k")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # statistics never broadcast
    try:
        assert "BroadcastHashJoin" in _plan(join_small(big, small, "k", small_rows=3))
        assert "BroadcastHashJoin" not in _plan(join_small(big, small, "k"))
        assert "BroadcastHashJoin" not in _plan(join_small(big, small, "k", small_rows=10**9))
        assert join_small(big, small, "k", small_rows=3).count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

"""Repeated rows against Spark's own DISTINCT and EXCEPT."""
import random

import pytest

from ledgerlens.operators import rowsets

SCHEMA = "a long, b string, c double, row_digest string"


def made(seed, n, values):
    g = random.Random(seed)
    return [(g.choice([None, *range(values)]), g.choice([None, "", "x", "xy"]), g.choice([None, 0.5, 1.5]), g.choice(["p", None])) for _ in range(n)]


@pytest.mark.parametrize("limit", [100_000, 3])
def test_distinct_and_except_equal_sparks(spark, monkeypatch, limit):
    monkeypatch.setattr("ledgerlens.operators.joins.join_small.__defaults__", ("inner", None, limit))
    a = spark.createDataFrame(made(1, 900, 40) + [(5, "hot", 1.0, "p")] * 400, SCHEMA).repartition(5)
    b = spark.createDataFrame(made(2, 300, 40), SCHEMA).toDF("z", "y", "x", "w")
    for got, want in ((rowsets.distinct_rows(a), a.distinct()), (rowsets.except_distinct(a, b), a.subtract(b))):
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_null_places_tell_rows_apart(spark):
    a = spark.createDataFrame([(None, 1), (1, None), (None, None), (1, 1)], "a long, b long")
    assert rowsets.distinct_rows(a).count() == 4
    assert rowsets.except_distinct(a, a.limit(0)).count() == 4
    assert rowsets.distinct_rows(a.limit(0)).count() == 0


def test_wide_rows_stay_where_they_are(spark):
    wide = spark.range(0, 3000, 1, 4).selectExpr("id", "repeat(cast(id AS string), 50) AS payload")
    other = wide.filter("id % 3 = 0")
    for df in (rowsets.distinct_rows(wide), rowsets.except_distinct(wide, other)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert rowsets.except_distinct(wide, other).count() == 2000

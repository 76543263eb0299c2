"""Every exact query against its DuckDB oracle (the driver's gate).

Runs at sf0.001 by default; ``LEDGERLENS_ORACLE_SF=/root/testdata/sf0.01``
runs the driver's scale.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens.plans import catalog
from conftest import SF_SMALL

TABLES = ["customer", "supplier", "orders", "lineitem"]
SF = os.environ.get("LEDGERLENS_ORACLE_SF", SF_SMALL)


def _norm(v):
    import pandas as pd

    if v is None or (not isinstance(v, (list, tuple, dict)) and pd.isna(v)):
        return "None"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return repr(v)
    if isinstance(v, (int, float)):
        return repr(round(float(v), 9) + 0.0)
    return repr(v)


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(_norm(df[c].iloc[i]) for c in cols) for i in range(len(df)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_oracle_names_a_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = catalog.queries()[name](spark, SF).toPandas()
    want = con.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    df = catalog.queries()[name](spark, SF)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["model"] == "LogisticRegression"
    assert [f.name for f in df.schema.fields] == ["model", "position", "Accuracy", "Precision", "Recall", "F1",
                                                  "ROC-AUC", "PR-AUC"]
    assert math.isfinite(rows[0]["F1"])
    assert os.path.exists(E.SMOKE_DIR)

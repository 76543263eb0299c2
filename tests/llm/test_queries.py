import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens.llm import queries

SF = "/root/testdata/sf0.001"


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(None if v != v or v is None else round(float(v), 6) if isinstance(v, float) else str(v) for v in r)
                   for r in df[cols].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SF).toPandas()[list(want.columns)]
    for c in want.columns:
        if got[c].dtype.kind == "f" and want[c].dtype.kind != "f" or want[c].dtype.kind == "f":
            got[c], want[c] = got[c].astype(float), want[c].astype(float)
    assert len(got) == len(want) and rows(got) == rows(want)


def test_all_are_registered():
    own = queries.queries()
    assert set(own) <= set(E.queries())
    assert {n.split("_")[0] for n in own} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


def test_native_operators_run_no_python(spark):
    for name in ("op2_url_filter", "op9_quality_rules"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas")), name

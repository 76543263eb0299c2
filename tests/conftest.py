import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, app="ledgerlens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wb(spark):
    from ledgerlens.plans.workbench import workbench

    return workbench(spark, SF_MID)


def txn_rows(spark, rows):
    """Hand-made transactions: (txn_id, type, amount, isFraud) + default balances."""
    from ledgerlens.sources.schema import TXN_SCHEMA

    full = [(i, 1, 2, t, a, 100.0, 50.0, 10.0, 60.0, y) for (i, t, a, y) in rows]
    return spark.createDataFrame(full, schema=TXN_SCHEMA)

import pytest

from ledgerlens.llm.common import prepare


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)

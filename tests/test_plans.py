"""Physical-plan audit of every registered query.

* no Python evaluation nodes (all expressions stay JVM-side),
* no Cartesian product or nested-loop join,
* every window is partitioned, except the one over the bounded table of
  score-range totals in the exact AUC (at most B rows).
"""

import re

import pytest

from ledgerlens.plans import catalog
from conftest import SF_SMALL

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan_audit(spark, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"
    for line in plan.splitlines():
        if "Window [" not in line:
            continue
        if "sum(bp#" in line:          # range totals: <= B rows by construction
            continue
        assert re.search(r"\], \[[^\]]*#\d+[^\]]*\], \[", line), f"{name}: unpartitioned window: {line.strip()}"

"""Joins with a checked broadcast.

A side is broadcast only when its row count has a proven bound at or below
``BROADCAST_MAX_ROWS`` (a label domain, a fitted model's category list, a
configured number of ranges).  Otherwise the strategy is left to the
optimizer: broadcast by statistics, sort-merge beyond them, and AQE splits
skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 100_000


def join_small(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner",
               small_rows: int | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``big`` joined with ``small``; ``small_rows`` is the proven upper bound
    of ``small``'s row count (None when unknown)."""
    if small_rows is not None and small_rows <= max_rows:
        small = F.broadcast(small)
    return big.join(small, on=on, how=how)

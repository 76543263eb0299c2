"""Partition-independent pseudo-random coin.

``u(salt, id)`` is uniform on [0, 1) and depends only on the salt and the
row's id, never on partition layout or task retries, so a lost executor
recomputes exactly the same sample.  The same value is computable in any SQL
engine that has ``md5`` (see the catalog's oracle SQL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schema import COIN_HEX_DIGITS, COIN_SCALE


def hash_coin(salt: str, id_col: Column | str) -> Column:
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    key = F.concat_ws("|", F.lit(salt), idc.cast("string"))
    digits = F.substring(F.md5(key), 1, COIN_HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(COIN_SCALE)


def coin_salt(purpose: str, seed: int) -> str:
    """Distinct salts per purpose: reusing one salt would send every kept
    majority row (small ``u``) to the training side."""
    return f"{purpose}{seed}"

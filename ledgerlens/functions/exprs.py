"""Scalar column expressions, all JVM-side built-ins (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.schema import FRAUD_TEXT, NOT_FRAUD_TEXT, PROBABILITY_THRESHOLD, TYPE_ORDINALS


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def guarded_ratio(num: Column | str, den: Column | str, default: float | None = 0.0) -> Column:
    """``num/den``, ``default`` when the denominator is 0 (ANSI-safe)."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return r if default is None else F.coalesce(r, F.lit(float(default)))


def label_text(x: Column | str) -> Column:
    """1 -> FRAUD, anything else (also NULL) -> NOT FRAUD."""
    return F.when(_c(x) == 1, F.lit(FRAUD_TEXT)).otherwise(F.lit(NOT_FRAUD_TEXT))


def ordinal_encode(x: Column | str, mapping: Mapping[str, int] = TYPE_ORDINALS) -> Column:
    """Fixed dictionary encoding; unknown keys give NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(int(v))]
    return F.create_map(*pairs)[_c(x)]


def over_threshold(p: Column | str, threshold: float = PROBABILITY_THRESHOLD) -> Column:
    """Strict ``p > threshold`` as int."""
    return (_c(p) > F.lit(float(threshold))).cast("int")


def fixed(x: Column | str, digits: int = 4) -> Column:
    """``%.{digits}f`` text; NULL stays NULL (``format_string`` alone would
    render it as the text "null")."""
    c = _c(x).cast("double")
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f", c))


def fixed4(x: Column | str) -> Column:
    return fixed(x, 4)


def squared_distance(arr: Column | str, centre: Sequence[float] | Column) -> Column:
    """Squared Euclidean distance between an array<double> and a centre."""
    c = centre if isinstance(centre, Column) else F.array(*[F.lit(float(v)) for v in centre])
    diffs = F.zip_with(_c(arr), c, lambda a, b: (a - b) * (a - b))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, d: acc + d)


def vector_element(vec: Column | str, i: int) -> Column:
    return vector_to_array(_c(vec))[i]


def score_of(df_schema: T.StructType, raw_col: str = "rawPrediction") -> Column:
    """Ranking score: element 1 of a rawPrediction vector, or the double itself."""
    dt = df_schema[raw_col].dataType
    if isinstance(dt, T.NumericType):
        return F.col(raw_col).cast("double")
    return vector_element(raw_col, 1)

"""Class ratio, majority downsampling, stratified split, set operations.

Default variants use the hash coin: no shuffle, no dependence on partition
layout, and a train/test split that is a pure filter pair over the same
input (disjoint by construction, no EXCEPT shuffle).  The reference's
``sample``/``sampleBy``/``subtract`` are kept as ``*_native`` variants.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coin import coin_salt, hash_coin
from ..functions.exprs import guarded_ratio
from ..sources.schema import DEFAULT_SEED, LABEL, MAJORITY_PER_MINORITY, SPLIT_FRACTIONS
from . import rowsets


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: n_fraud, n_nonfraud, n_total -- a single fused aggregate
    (partial counts per task, one tiny final merge)."""
    return df.agg(
        F.count_if(F.col(label) == 1.0).alias("n_fraud"),
        F.count_if(F.col(label) == 0.0).alias("n_nonfraud"),
        F.count(F.lit(1)).alias("n_total"),
    )


def class_ratio(df: DataFrame, label: str = LABEL) -> DataFrame:
    """fraud / nonfraud, 0 when there are no non-fraud rows."""
    c = class_counts(df, label)
    return c.select("n_fraud", "n_nonfraud", guarded_ratio("n_fraud", "n_nonfraud").alias("ratio"))


def keep_fraction(df: DataFrame, label: str = LABEL, per_minority: float = MAJORITY_PER_MINORITY) -> Column:
    """Scalar-subquery column: min(ratio * per_minority, 1.0)."""
    ratio = class_ratio(df, label).select(
        F.least(F.col("ratio") * F.lit(float(per_minority)), F.lit(1.0)).alias("f"))
    return ratio.scalar()


def balance(df: DataFrame, id_col: str = "txn_id", label: str = LABEL,
            seed: int = DEFAULT_SEED, per_minority: float = MAJORITY_PER_MINORITY) -> DataFrame:
    """All positives plus each negative with probability min(3*ratio, 1).

    One scan with a single OR predicate (the union of the two class filters);
    the fraction arrives as a scalar subquery, so the plan stays lazy.
    """
    f = keep_fraction(df, label, per_minority)
    u = hash_coin(coin_salt("bal", seed), id_col)
    keep = (F.col(label) == 1.0) | ((F.col(label) == 0.0) & (u < f))
    return df.filter(keep)


def balance_native(df: DataFrame, label: str = LABEL, seed: int = DEFAULT_SEED,
                   per_minority: float = MAJORITY_PER_MINORITY) -> DataFrame:
    """The reference's form: ``sample`` of the majority union all positives.
    Depends on partition layout; the fraction is a driver-side scalar."""
    row = class_ratio(df, label).first()
    frac = min(float(row["ratio"]) * per_minority, 1.0)
    neg = df.filter(F.col(label) == 0.0).sample(withReplacement=False, fraction=frac, seed=seed)
    return neg.unionByName(df.filter(F.col(label) == 1.0))


def sample_bernoulli_native(df: DataFrame, fraction: float, seed: int = DEFAULT_SEED) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def stratum_fraction(label: str, fractions: Mapping[float, float]) -> Column:
    """CASE label WHEN k THEN f ... ELSE 0 (unlisted strata are never drawn)."""
    expr = F.lit(0.0)
    for k, f in fractions.items():
        expr = F.when(F.col(label) == F.lit(float(k)), F.lit(float(f))).otherwise(expr)
    return expr


def train_mask(id_col: str = "txn_id", label: str = LABEL,
               fractions: Mapping[float, float] = SPLIT_FRACTIONS, seed: int = DEFAULT_SEED) -> Column:
    u = hash_coin(coin_salt("split", seed), id_col)
    return F.coalesce(u < stratum_fraction(label, fractions), F.lit(False))


def stratified_sample(df: DataFrame, id_col: str = "txn_id", label: str = LABEL,
                      fractions: Mapping[float, float] = SPLIT_FRACTIONS,
                      seed: int = DEFAULT_SEED) -> DataFrame:
    return df.filter(train_mask(id_col, label, fractions, seed))


def split_train_test(df: DataFrame, id_col: str = "txn_id", label: str = LABEL,
                     fractions: Mapping[float, float] = SPLIT_FRACTIONS,
                     seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    """Train = stratified draw; test = its complement.  Two filters, no shuffle."""
    m = train_mask(id_col, label, fractions, seed)
    return df.filter(m), df.filter(~m)


def sample_by_native(df: DataFrame, label: str = LABEL,
                     fractions: Mapping[float, float] = SPLIT_FRACTIONS,
                     seed: int = DEFAULT_SEED) -> DataFrame:
    return df.sampleBy(label, dict(fractions), seed=seed)


def split_except_strict(df: DataFrame, id_col: str = "txn_id", label: str = LABEL,
                        fractions: Mapping[float, float] = SPLIT_FRACTIONS,
                        seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    """The reference's semantics: test = all EXCEPT DISTINCT train.

    Whether a row is drawn depends on its values alone, so equal rows are on the
    same side, and what is left after EXCEPT is the complement of the draw, made
    distinct.  That moves digests, and of the rows only repeated ones."""
    m = train_mask(id_col, label, fractions, seed)
    return df.filter(m), rowsets.distinct_rows(df.filter(~m))


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union keeping duplicates, matched by column name."""
    return a.unionByName(b)


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """EXCEPT DISTINCT (null-safe, by position): see :func:`rowsets.except_distinct`."""
    return rowsets.except_distinct(a, b)

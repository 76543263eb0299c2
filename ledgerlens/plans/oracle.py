"""Oracle SQL building blocks (DuckDB dialect) for the catalog.

The same fixed values as the Spark side are used to generate the CTEs, so the
two engines compute the fixture, the hash coin, the balance and the split
independently but from one definition.
"""

from __future__ import annotations

from ..sources.schema import COIN_HEX_DIGITS, COIN_SCALE, DEFAULT_SEED, MAJORITY_PER_MINORITY, SPLIT_FRACTIONS
from ..sources.tables import (
    AMOUNT_DIVISOR, FRAUD_MIN_AMOUNT, FRAUD_PRIORITIES, OPEN_STATUS, OTHER_TYPE, PRIORITY_TO_TYPE,
)


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def coin_sql(salt: str, id_expr: str) -> str:
    return (f"(CAST(CAST('0x' || substr(md5('{salt}' || '|' || CAST({id_expr} AS VARCHAR)), 1, "
            f"{COIN_HEX_DIGITS}) AS BIGINT) AS DOUBLE) / {dbl(COIN_SCALE)})")


def _type_case() -> str:
    whens = " ".join(f"WHEN '{p}' THEN '{t}'" for p, t in PRIORITY_TO_TYPE)
    return f"CASE o_orderpriority {whens} ELSE '{OTHER_TYPE}' END"


def txn_ctes() -> str:
    amt = f"(o_totalprice / {dbl(AMOUNT_DIVISOR)})"
    pri = ", ".join(f"'{p}'" for p in FRAUD_PRIORITIES)
    return f"""dest AS (SELECT l_orderkey, min(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey),
txn AS (
  SELECT o_orderkey AS txn_id, o_custkey AS name_orig, sk AS name_dest,
    {_type_case()} AS type,
    {amt} AS amount,
    c_acctbal AS oldbalanceOrg,
    greatest(c_acctbal - {amt}, {dbl(0)}) AS newbalanceOrig,
    coalesce(s_acctbal, {dbl(0)}) AS oldbalanceDest,
    coalesce(s_acctbal + {amt}, {dbl(0)}) AS newbalanceDest,
    CASE WHEN o_orderpriority IN ({pri}) AND {amt} > {dbl(FRAUD_MIN_AMOUNT)}
          AND {amt} > c_acctbal AND o_orderstatus <> '{OPEN_STATUS}' THEN {dbl(1)} ELSE {dbl(0)} END AS isFraud
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN dest ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON s_suppkey = sk)"""


def sample_ctes(seed: int = DEFAULT_SEED) -> str:
    frac_case = "CASE isFraud " + " ".join(
        f"WHEN {dbl(k)} THEN {dbl(v)}" for k, v in SPLIT_FRACTIONS.items()) + f" ELSE {dbl(0)} END"
    return f"""cnt AS (SELECT CAST(count_if(isFraud = 1.0) AS BIGINT) AS n_fraud, CAST(count_if(isFraud = 0.0) AS BIGINT) AS n_nonfraud,
                      count(*) AS n_total FROM txn),
frac AS (SELECT least(CASE WHEN n_nonfraud = 0 THEN {dbl(0)}
                      ELSE CAST(n_fraud AS DOUBLE) / CAST(n_nonfraud AS DOUBLE) END
                      * {dbl(MAJORITY_PER_MINORITY)}, {dbl(1)}) AS f FROM cnt),
balanced AS (SELECT txn.* FROM txn, frac
             WHERE txn.isFraud = 1.0 OR (txn.isFraud = 0.0 AND {coin_sql(f'bal{seed}', 'txn.txn_id')} < frac.f)),
marked AS (SELECT balanced.*, coalesce({coin_sql(f'split{seed}', 'txn_id')} < {frac_case}, false) AS is_train
           FROM balanced),
train AS (SELECT * EXCLUDE (is_train) FROM marked WHERE is_train),
test AS (SELECT * EXCLUDE (is_train) FROM marked WHERE NOT is_train)"""


def with_base(body_ctes: str | None, select: str, seed: int = DEFAULT_SEED) -> str:
    ctes = [txn_ctes(), sample_ctes(seed)]
    if body_ctes:
        ctes.append(body_ctes)
    return "WITH " + ",\n".join(ctes) + "\n" + select


def type_index_cte(src: str = "train", name: str = "idx") -> str:
    """StringIndexer order: frequency desc, ties by label asc."""
    return (f"{name} AS (SELECT type, CAST(row_number() OVER (ORDER BY count(*) DESC, type ASC) - 1 AS DOUBLE)"
            f" AS type_index FROM {src} WHERE type IS NOT NULL GROUP BY type)")


def auc_select(scored: str, score: str = "score", label: str = "isFraud") -> str:
    """Exact ROC/PR AUC (one curve point per distinct score) over ``scored``."""
    return f"""pts AS (SELECT {score} AS s, CAST(count_if({label} > 0.5) AS BIGINT) AS pos, CAST(count_if({label} <= 0.5) AS BIGINT) AS neg
         FROM {scored} WHERE {score} IS NOT NULL GROUP BY {score}),
cum AS (SELECT CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
               CAST(sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS tp,
               CAST(sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS fp FROM pts),
auc_terms AS (SELECT pos, neg, tp, fp, tp / (tp + fp) AS prec,
               CASE WHEN (tp - pos) + (fp - neg) = 0 THEN tp / (tp + fp)
                    ELSE (tp - pos) / ((tp - pos) + (fp - neg)) END AS prev_prec FROM cum),
auc AS (SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                    THEN sum(neg * (2 * tp - pos)) / (2 * sum(pos) * sum(neg)) END AS roc_auc,
               CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                    THEN sum(pos * (prec + prev_prec)) / (2 * sum(pos)) END AS pr_auc,
               CAST(coalesce(sum(pos), 0) AS BIGINT) AS n_pos, CAST(coalesce(sum(neg), 0) AS BIGINT) AS n_neg
        FROM auc_terms)"""

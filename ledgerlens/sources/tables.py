"""Readers for the driver's parquet tables and the labelled ``txn`` fixture.

The fixture turns the TPC-H-like star schema into a labelled, imbalanced
transaction table with the reference's columns.  It is written with the
DataFrame API so Catalyst prunes every scan to the columns used and pushes
the join keys' null filters into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table.  A missing path raises ``InputNotFound``."""
    from .files import read_parquet_checked

    return read_parquet_checked(spark, table_path(sf_dir, name))


# ---------------------------------------------------------------------------
# Fixed values of the fixture (order priority -> transaction type, label rule)
# ---------------------------------------------------------------------------
PRIORITY_TO_TYPE = [
    ("1-URGENT", "TRANSFER"),
    ("2-HIGH", "CASH_OUT"),
    ("3-MEDIUM", "PAYMENT"),
    ("4-NOT SPECIFIED", "DEBIT"),
]
OTHER_TYPE = "CASH_IN"
FRAUD_PRIORITIES = ["1-URGENT", "2-HIGH"]
AMOUNT_DIVISOR = 50.0
FRAUD_MIN_AMOUNT = 7000.0
OPEN_STATUS = "O"
# ---------------------------------------------------------------------------


def txn_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled transactions: one row per order (``txn_id`` is unique).

    Plan at scale: lineitem is reduced to one row per order with a partial
    (map-side) ``min`` before its shuffle; the aggregate's hash partitioning
    on the order key is reused by the outer join with orders.  Customer and
    supplier joins are left to the optimizer: broadcast while the statistics
    are under ``spark.sql.autoBroadcastJoinThreshold``, sort-merge beyond it,
    and AQE splits a hot customer or supplier key (skew join) at run time.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    dest = (read_table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey").agg(F.min("l_suppkey").alias("sk")))

    amount = F.col("o_totalprice") / F.lit(AMOUNT_DIVISOR)
    type_col = F.lit(OTHER_TYPE)
    for priority, kind in reversed(PRIORITY_TO_TYPE):
        type_col = F.when(F.col("o_orderpriority") == priority, F.lit(kind)).otherwise(type_col)
    fraud_rule = (F.col("o_orderpriority").isin(*FRAUD_PRIORITIES)
                  & (amount > F.lit(FRAUD_MIN_AMOUNT))
                  & (amount > F.col("c_acctbal"))
                  & (F.col("o_orderstatus") != F.lit(OPEN_STATUS)))

    joined = (orders
              .join(dest, orders.o_orderkey == dest.l_orderkey, "left")
              .join(customer, orders.o_custkey == customer.c_custkey, "inner")
              .join(supplier, F.col("sk") == supplier.s_suppkey, "left"))
    return joined.select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("name_orig"),
        F.col("sk").alias("name_dest"),
        type_col.alias("type"),
        amount.alias("amount"),
        F.col("c_acctbal").alias("oldbalanceOrg"),
        F.greatest(F.col("c_acctbal") - amount, F.lit(0.0)).alias("newbalanceOrig"),
        F.coalesce(F.col("s_acctbal"), F.lit(0.0)).alias("oldbalanceDest"),
        F.coalesce(F.col("s_acctbal") + amount, F.lit(0.0)).alias("newbalanceDest"),
        F.when(fraud_rule, F.lit(1.0)).otherwise(F.lit(0.0)).alias("isFraud"),
    )

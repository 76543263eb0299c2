"""Schemas, column names and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the reference's for matching results)
# ---------------------------------------------------------------------------
LABEL = "isFraud"
TYPE = "type"
NUMERIC_FEATURES = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
FORM_NUMBERS = ["amount", "oldbalanceOrg", "newbalanceOrig"]      # the scoring form: these and the type
WIDE_EXTRA_FEATURES = ["deltaOrig", "deltaDest", "balanceMismatch"]
WEIGHT_COL = "classWeightCol"
TYPE_ORDINALS = {"PAYMENT": 0, "TRANSFER": 1, "CASH_OUT": 2, "DEBIT": 3}
FRAUD_TEXT = "FRAUD"
NOT_FRAUD_TEXT = "NOT FRAUD"
METRIC_NAMES = ["Accuracy", "Precision", "Recall", "F1", "ROC-AUC", "PR-AUC"]
DEFAULT_SEED = 42
MAJORITY_PER_MINORITY = 3.0          # majority kept at 3:1 against the positives
SPLIT_FRACTIONS = {0.0: 0.8, 1.0: 0.8}
PROBABILITY_THRESHOLD = 0.5
CLUSTER_MAJORITY_RATE = 0.5
LR_MAX_ITER = 10
RF_NUM_TREES, RF_MAX_DEPTH = 50, 10
BOOST_ROUNDS, BOOST_MAX_DEPTH, BOOST_STEP = 50, 6, 0.1
PCA_K, KMEANS_K = 5, 2
WIDE_LR_MAX_ITER = 50
# ---------------------------------------------------------------------------

# Hash coin: 7 hex digits of md5 give a uniform integer in [0, 16^7).
COIN_HEX_DIGITS = 7
COIN_SCALE = float(16 ** COIN_HEX_DIGITS)

TXN_SCHEMA = T.StructType([
    T.StructField("txn_id", T.LongType(), True),
    T.StructField("name_orig", T.LongType(), True),
    T.StructField("name_dest", T.LongType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("oldbalanceOrg", T.DoubleType(), True),
    T.StructField("newbalanceOrig", T.DoubleType(), True),
    T.StructField("oldbalanceDest", T.DoubleType(), True),
    T.StructField("newbalanceDest", T.DoubleType(), True),
    T.StructField("isFraud", T.DoubleType(), True),
])

# Raw CSV as written by upstream systems: the label arrives as text/int.
TXN_CSV_SCHEMA = T.StructType(
    [f if f.name != LABEL else T.StructField(LABEL, T.StringType(), True) for f in TXN_SCHEMA.fields]
)

# Payments-log layout of the reference's input CSV (declared: no inference
# pass over the file).  Fixed values: column names and order of that log.
PAYMENTS_CSV_SCHEMA = T.StructType([
    T.StructField("step", T.IntegerType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("nameOrig", T.StringType(), True),
    T.StructField("oldbalanceOrg", T.DoubleType(), True),
    T.StructField("newbalanceOrig", T.DoubleType(), True),
    T.StructField("nameDest", T.StringType(), True),
    T.StructField("oldbalanceDest", T.DoubleType(), True),
    T.StructField("newbalanceDest", T.DoubleType(), True),
    T.StructField("isFraud", T.StringType(), True),
    T.StructField("isFlaggedFraud", T.IntegerType(), True),
])

# One scoring request (the dashboard form, widened to the fitted features).
REQUEST_SCHEMA = T.StructType([
    T.StructField("txn_id", T.LongType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("oldbalanceOrg", T.DoubleType(), True),
    T.StructField("newbalanceOrig", T.DoubleType(), True),
    T.StructField("oldbalanceDest", T.DoubleType(), True),
    T.StructField("newbalanceDest", T.DoubleType(), True),
])

# The scoring form alone: four fields.
FORM_SCHEMA = T.StructType([f for f in REQUEST_SCHEMA.fields if f.name in (TYPE, *FORM_NUMBERS)])

METRICS_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
])

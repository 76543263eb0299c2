"""Query catalog: every operator of the inventory as a named Spark plan, each
paired (where SQL can express it) with an independent DuckDB oracle.

Queries take ``(spark, sf_dir)`` and return a DataFrame over the whole
tables.  Exact-class queries (E/ER) round computed doubles on both sides
(4 dp for model outputs, 6 for statistics, 9 for evaluation metrics).
Where a fitted model has no closed form, the query returns what must hold for
it (score equations, a rule that it has to find) next to the moments of the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coin import coin_salt, hash_coin
from ..functions.exprs import fixed4, label_text, ordinal_encode, over_threshold
from ..operators import anomaly, evaluation as ev, explain, features as feat, models, sampling, scoring
from ..operators.joins import join_small
from ..sources import files
from ..sources.schema import (
    FORM_SCHEMA, LABEL, METRIC_NAMES, NUMERIC_FEATURES, REQUEST_SCHEMA, SPLIT_FRACTIONS, TXN_CSV_SCHEMA, TYPE_ORDINALS, WEIGHT_COL,
)
from ..streaming import scoring_stream
from . import oracle as O
from ..operators.parallel import side_by_side
from .workbench import workbench


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    klass: str


CATALOG: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, klass: str = "E"):
    def deco(fn):
        CATALOG[name] = Entry(name, fn, sql, klass)
        return fn
    return deco


def _wb(spark, sf_dir):
    return workbench(spark, sf_dir)


# ---------------------------------------------------------------------------
# Rule scorers used as SQL-expressible models (our definitions)
# name, score expression, prediction expression (Spark SQL == DuckDB SQL text)
# ---------------------------------------------------------------------------
RULES = [
    ("AmountRule", "amount", "amount > 7000.0"),
    ("DrainRule", "amount - oldbalanceOrg", "amount > oldbalanceOrg"),
    ("TypeRule", "CASE WHEN type IN ('TRANSFER', 'CASH_OUT') THEN 1.0 ELSE 0.0 END",
     "type IN ('TRANSFER', 'CASH_OUT')"),
]
RF_RULE_BUCKET = 1000.0     # model_rf_rule: feature floor(amount / 1000)
RF_RULE_CUT = 7.0           # label = bucket >= 7
KMEANS_1D_SCALE = 1000.0    # model_kmeans_1d: x = amount / 1000
METRIC_DIGITS = 9
# ---------------------------------------------------------------------------


def _rule_scored(df: DataFrame, rule=RULES[0]) -> DataFrame:
    _, score, pred = rule
    return df.withColumn("score", F.expr(score).cast("double")).withColumn(
        "prediction", F.coalesce(F.expr(pred), F.lit(False)).cast("double"))


def _rule_scored_sql(rule=RULES[0], src: str = "test") -> str:
    _, score, pred = rule
    return (f"SELECT {src}.*, CAST({score} AS DOUBLE) AS score, "
            f"CAST(coalesce({pred}, false) AS DOUBLE) AS prediction FROM {src}")


# =========================================================== sources / sinks
@query("src_csv_scan", O.with_base(None, "SELECT * REPLACE (CAST(name_dest AS VARCHAR) AS name_dest) FROM txn"))
def src_csv_scan(spark, sf_dir):
    """Write the transactions as CSV to the shared folder, read them back with
    the declared schema (no inference job) and ``try_cast`` the label."""
    path = files.scratch_dir(spark, "csv")
    txn = _wb(spark, sf_dir).txn
    txn.withColumn(LABEL, F.col(LABEL).cast("int").cast("string")).write.option("header", True).csv(path)
    back = files.read_txn_csv(spark, path).select(*[f.name for f in TXN_CSV_SCHEMA.fields])
    # the nullable destination id is returned as text (lossless, same in any engine)
    return back.withColumn("name_dest", F.col("name_dest").cast("string"))


@query("src_labelled_csv", O.with_base(None, "SELECT type, amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest, "
                                       "newbalanceDest, isFraud FROM txn"))
def src_labelled_csv(spark, sf_dir):
    """A labelled CSV without ids, schema inferred (the reference's read):
    label cast, content key added, required columns checked."""
    path = files.scratch_dir(spark, "labelled-csv")
    cols = ["type"] + NUMERIC_FEATURES
    (_wb(spark, sf_dir).txn.select(*cols, F.col(LABEL).cast("int").alias(LABEL))
        .write.option("header", True).csv(path))
    df = files.read_labelled_csv(spark, path)
    return df.select(*cols, LABEL)


@query("src_request_rows", O.with_base(None, "SELECT " + ", ".join(f.name for f in REQUEST_SCHEMA.fields)
                                       + " FROM test"))
def src_request_rows(spark, sf_dir):
    """Scoring requests conformed to the request schema (``DataFrame.to``)."""
    return _wb(spark, sf_dir).test.select(*[f.name for f in REQUEST_SCHEMA.fields]).to(REQUEST_SCHEMA)


def _rules_scored(spark, sf_dir) -> list[tuple[str, DataFrame]]:
    test = _wb(spark, sf_dir).test
    return [(rule[0], _rule_scored(test, rule)) for rule in RULES]


def _rules_long(spark, sf_dir) -> DataFrame:
    long = ev.metrics_long(_rules_scored(spark, sf_dir), score=F.col("score"))
    return long.withColumn("value", F.round("value", METRIC_DIGITS))


def _rules_long_sql() -> str:
    return _models_sql([(rule[0], _rule_scored_sql(rule)) for rule in RULES])


def _models_sql(scored: list[tuple[str, str]]) -> str:
    """CTEs up to ``mw``, the raw metrics of each (name, SQL of its scored rows)."""
    parts, ctes = [], []
    for pos, (name, rows) in enumerate(scored):
        ctes.append(f"sc{pos} AS ({rows})")
        auc = O.auc_select(f"sc{pos}").replace("pts AS", f"pts{pos} AS").replace("FROM pts", f"FROM pts{pos}")
        auc = (auc.replace("cum AS", f"cum{pos} AS").replace("FROM cum", f"FROM cum{pos}")
                  .replace("auc_terms AS", f"auc_terms{pos} AS").replace("FROM auc_terms", f"FROM auc_terms{pos}")
                  .replace("auc AS", f"auc{pos} AS"))
        ctes.append(auc)
        ctes.append(f"""cf{pos} AS (SELECT CAST(count_if(isFraud = 1.0 AND prediction = 1.0) AS BIGINT) AS tp,
  CAST(count_if(isFraud = 0.0 AND prediction = 0.0) AS BIGINT) AS tn, CAST(count_if(isFraud = 0.0 AND prediction = 1.0) AS BIGINT) AS fp,
  CAST(count_if(isFraud = 1.0 AND prediction = 0.0) AS BIGINT) AS fn FROM sc{pos})""")
        ctes.append(f"""m{pos} AS (SELECT '{name}' AS model, {pos} AS position, {_prf_sql('cf' + str(pos))},
  roc_auc AS "ROC-AUC", pr_auc AS "PR-AUC" FROM cf{pos}, auc{pos})""")
        parts.append(f"SELECT * FROM m{pos}")
    ctes.append("mw AS (" + " UNION ALL ".join(parts) + ")")
    return ",\n".join(ctes)


def _prf_sql(src: str) -> str:
    return """CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS p_,
  CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS r_,
  CASE WHEN tp + tn + fp + fn > 0 THEN CAST(tp + tn AS DOUBLE) / CAST(tp + tn + fp + fn AS DOUBLE) END AS a_"""


_UNPIVOT_SQL = """long AS (
  SELECT model, position, metric, round(value, {d}) AS value FROM (
    SELECT model, position, 'Accuracy' AS metric, a_ AS value FROM mw2 UNION ALL
    SELECT model, position, 'Precision', p_ FROM mw2 UNION ALL
    SELECT model, position, 'Recall', r_ FROM mw2 UNION ALL
    SELECT model, position, 'F1', f1_ FROM mw2 UNION ALL
    SELECT model, position, 'ROC-AUC', "ROC-AUC" FROM mw2 UNION ALL
    SELECT model, position, 'PR-AUC', "PR-AUC" FROM mw2))""".format(d=METRIC_DIGITS)

_MW2_SQL = """mw2 AS (SELECT *, CASE WHEN p_ + r_ > 0 THEN 2.0 * p_ * r_ / (p_ + r_) ELSE 0.0 END AS f1_ FROM mw)"""


def _metrics_long_sql() -> str:
    return O.with_base(_rules_long_sql() + ",\n" + _MW2_SQL + ",\n" + _UNPIVOT_SQL,
                       "SELECT model, position, metric, value FROM long")


@query("metrics_json_roundtrip", _metrics_long_sql())
def metrics_json_roundtrip(spark, sf_dir):
    """Metrics sink to JSON and source back with a declared schema."""
    path = files.scratch_dir(spark, "metrics")
    files.write_metrics_json(_rules_long(spark, sf_dir).drop("position"), path)
    back = files.read_metrics_json(spark, path)
    pos = {r[0]: i for i, r in enumerate(RULES)}
    position = F.lit(None).cast("int")
    for name, i in pos.items():
        position = F.when(F.col("model") == name, F.lit(i)).otherwise(position)
    return back.select("model", position.alias("position"), "metric", "value")


# ====================================================== projections / predicates
@query("proj_label_cast", O.with_base(None, "SELECT txn_id, isFraud FROM txn"))
def proj_label_cast(spark, sf_dir):
    """Text labels (as read from CSV) cast with ``try_cast``; bad text -> NULL."""
    raw = _wb(spark, sf_dir).txn.select("txn_id", F.col(LABEL).cast("int").cast("string").alias(LABEL))
    return raw.select("txn_id", F.col(LABEL).try_cast("double").alias(LABEL))


@query("filter_class", O.with_base(None, "SELECT txn_id, type, amount FROM txn WHERE isFraud = 1.0"))
def filter_class(spark, sf_dir):
    return _wb(spark, sf_dir).txn.filter(F.col(LABEL) == 1.0).select("txn_id", "type", "amount")


_ORD_CASE = "CASE type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in TYPE_ORDINALS.items()) + " END"


@query("proj_ordinal_encode", O.with_base(None, f"SELECT txn_id, type, CAST({_ORD_CASE} AS DOUBLE) AS type_code "
                                          "FROM txn"))
def proj_ordinal_encode(spark, sf_dir):
    """Fixed dictionary code as a feature value (double; unknown -> NULL)."""
    return _wb(spark, sf_dir).txn.select("txn_id", "type", ordinal_encode("type").cast("double").alias("type_code"))


_TYPE_RATE_CTE = "rate AS (SELECT type, avg(isFraud) AS p FROM train GROUP BY type)"


def _type_rate(train: DataFrame) -> DataFrame:
    """Empirical fraud probability per type on the training side (the closed
    form of the saturated one-hot model)."""
    return train.groupBy("type").agg(F.avg(LABEL).alias("p"))


def _with_type_rate(wb) -> DataFrame:
    """Test rows with their type's rate.  The rate table has one row per type
    (plus NULL); the fitted indexer's label list bounds that count, so the
    broadcast is checked -- beyond the bound the optimizer picks the join."""
    n_types = len(wb.feature_model().stages[0].labels) + 1
    return join_small(wb.test, _type_rate(wb.train), "type", "left", small_rows=n_types)


@query("proj_threshold", O.with_base(_TYPE_RATE_CTE,
                                     "SELECT test.txn_id, round(rate.p, 4) AS probability, "
                                     "CAST(rate.p > 0.5 AS INTEGER) AS prediction "
                                     "FROM test LEFT JOIN rate ON test.type = rate.type"))
def proj_threshold(spark, sf_dir):
    scored = _with_type_rate(_wb(spark, sf_dir))
    return scored.select("txn_id", F.round("p", 4).alias("probability"), over_threshold("p").alias("prediction"))


@query("proj_label_text", O.with_base(_TYPE_RATE_CTE,
                                      "SELECT test.txn_id, CASE WHEN rate.p > 0.5 THEN 'FRAUD' ELSE 'NOT FRAUD' END "
                                      "AS label_text, printf('%.4f', round(rate.p, 4)) AS probability_text "
                                      "FROM test LEFT JOIN rate ON test.type = rate.type"))
def proj_label_text(spark, sf_dir):
    scored = _with_type_rate(_wb(spark, sf_dir))
    return scored.select("txn_id", label_text(over_threshold("p")).alias("label_text"),
                         fixed4(F.round("p", 4)).alias("probability_text"))


@query("feat_balance_deltas", O.with_base(None, """SELECT txn_id, oldbalanceOrg - newbalanceOrig AS deltaOrig,
  newbalanceDest - oldbalanceDest AS deltaDest,
  CAST(coalesce(abs((oldbalanceOrg - newbalanceOrig) - amount) > 0.01
       OR abs((newbalanceDest - oldbalanceDest) - amount) > 0.01, false) AS DOUBLE) AS balanceMismatch
FROM txn"""))
def feat_balance_deltas(spark, sf_dir):
    return feat.with_balance_deltas(_wb(spark, sf_dir).txn).select(
        "txn_id", "deltaOrig", "deltaDest", "balanceMismatch")


@query("feat_class_weights", O.with_base(
    """w AS (SELECT CAST(count_if(isFraud = 0.0) AS BIGINT) AS n0, CAST(count_if(isFraud = 1.0) AS BIGINT) AS n1 FROM train)""",
    """SELECT txn_id, isFraud, round(CASE WHEN isFraud = 0.0 THEN CAST(n0 + n1 AS DOUBLE) / (2.0 * n0)
                                      ELSE CAST(n0 + n1 AS DOUBLE) / (2.0 * n1) END, 6) AS classWeightCol
FROM train, w"""))
def feat_class_weights(spark, sf_dir):
    out = feat.with_class_weights(_wb(spark, sf_dir).train)
    return out.select("txn_id", LABEL, F.round(WEIGHT_COL, 6).alias(WEIGHT_COL))


# ================================================================= sampling
@query("agg_class_ratio", O.with_base(None, """SELECT n_fraud, n_nonfraud,
  round(CASE WHEN n_nonfraud = 0 THEN 0.0 ELSE CAST(n_fraud AS DOUBLE) / n_nonfraud END, 6) AS ratio FROM cnt"""))
def agg_class_ratio(spark, sf_dir):
    r = sampling.class_ratio(_wb(spark, sf_dir).txn)
    return r.select("n_fraud", "n_nonfraud", F.round("ratio", 6).alias("ratio"))


@query("sample_balance_3to1", O.with_base(None, "SELECT txn_id, isFraud FROM balanced"))
def sample_balance_3to1(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    return sampling.balance(wb.txn, seed=wb.seed).select("txn_id", LABEL)


def _draw_checks(drawn: DataFrame, source: DataFrame, fraction: Column, by: str) -> DataFrame:
    """What must hold for a native draw, as rows (class, check, value): how many of
    the class there are, how many drawn rows are not rows of the input or occur
    twice, and whether the number drawn is within four standard deviations."""
    n = source.groupBy(by).agg(F.count(F.lit(1)).alias("rows")).withColumn("f", fraction)
    got = drawn.groupBy(by).agg(F.count(F.lit(1)).alias("drawn"), F.count_distinct("txn_id").alias("ids"))
    strange = drawn.join(source.select("txn_id", F.col(by).alias("own")), "txn_id", "left").groupBy(by).agg(
        F.count_if(~F.col("own").eqNullSafe(F.col(by))).alias("strange"))
    all_ = n.join(got, by, "left").join(strange, by, "left").na.fill(0, ["drawn", "ids", "strange"])
    sigma = F.sqrt(F.col("rows") * F.col("f") * (1 - F.col("f")))
    near = F.abs(F.col("drawn") - F.col("rows") * F.col("f")) <= 4 * sigma
    return all_.select(F.col(by).alias("label"), F.col("rows").cast("long").alias("rows"),
                       F.col("strange").cast("long").alias("outside_input"), (F.col("drawn") - F.col("ids")).cast("long").alias("drawn_twice"),
                       near.alias("within_four_sigma"))


@query("sample_bernoulli_native", O.with_base(None, """SELECT isFraud AS label, count(*) AS rows, CAST(0 AS BIGINT) AS outside_input,
  CAST(0 AS BIGINT) AS drawn_twice, true AS within_four_sigma FROM txn GROUP BY isFraud"""))
def sample_bernoulli_native(spark, sf_dir):
    """The native draw of the majority and all positives, checked per class: a
    positive is drawn with probability one, so all of them must be there."""
    wb = _wb(spark, sf_dir)
    f = F.when(F.col(LABEL) == 1.0, F.lit(1.0)).otherwise(sampling.keep_fraction(wb.txn))
    return _draw_checks(sampling.balance_native(wb.txn, seed=wb.seed).select("txn_id", LABEL), wb.txn, f, LABEL)


@query("sample_stratified_native", O.with_base(None, """SELECT isFraud AS label, count(*) AS rows, CAST(0 AS BIGINT) AS outside_input,
  CAST(0 AS BIGINT) AS drawn_twice, true AS within_four_sigma FROM balanced GROUP BY isFraud"""))
def sample_stratified_native(spark, sf_dir):
    """The native stratified draw (``sampleBy``), checked per class."""
    wb = _wb(spark, sf_dir)
    f = sampling.stratum_fraction(LABEL, SPLIT_FRACTIONS)
    return _draw_checks(sampling.sample_by_native(wb.balanced, seed=wb.seed).select("txn_id", LABEL), wb.balanced, f, LABEL)


@query("sample_stratified", O.with_base(None, "SELECT txn_id, isFraud FROM train"))
def sample_stratified(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    return sampling.stratified_sample(wb.balanced, seed=wb.seed).select("txn_id", LABEL)


@query("split_train_test", O.with_base(None, """SELECT txn_id, isFraud, 'train' AS side FROM train
UNION ALL SELECT txn_id, isFraud, 'test' AS side FROM test"""))
def split_train_test(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    tr, te = sampling.split_train_test(wb.balanced, seed=wb.seed)
    return (tr.select("txn_id", LABEL, F.lit("train").alias("side"))
              .unionByName(te.select("txn_id", LABEL, F.lit("test").alias("side"))))


@query("split_except_strict", O.with_base(None, """SELECT * REPLACE (CAST(name_dest AS VARCHAR) AS name_dest)
FROM (SELECT * FROM balanced EXCEPT SELECT * FROM train)"""))
def split_except_strict(spark, sf_dir):
    """EXCEPT DISTINCT over whole rows; the nullable destination id is
    returned as text (lossless)."""
    wb = _wb(spark, sf_dir)
    test = sampling.split_except_strict(wb.balanced, seed=wb.seed)[1]
    return test.withColumn("name_dest", F.col("name_dest").cast("string"))


@query("set_union_all", O.with_base(None, """SELECT txn_id, isFraud FROM txn, frac
  WHERE isFraud = 0.0 AND """ + O.coin_sql("bal42", "txn_id") + """ < frac.f
UNION ALL SELECT txn_id, isFraud FROM txn WHERE isFraud = 1.0"""))
def set_union_all(spark, sf_dir):
    """The reference's two-branch form of the balance: majority draw UNION ALL
    positives (duplicates kept, matched by name)."""
    wb = _wb(spark, sf_dir)
    txn = wb.txn
    f = sampling.keep_fraction(txn)
    neg = txn.filter((F.col(LABEL) == 0.0) & (hash_coin(coin_salt("bal", wb.seed), "txn_id") < f))
    return sampling.union_all(neg.select("txn_id", LABEL), txn.filter(F.col(LABEL) == 1.0).select("txn_id", LABEL))


@query("set_except_distinct", O.with_base(None, """SELECT name_orig, type FROM txn
EXCEPT SELECT name_orig, type FROM balanced"""))
def set_except_distinct(spark, sf_dir):
    """(customer, type) pairs that occur only among the dropped majority rows."""
    wb = _wb(spark, sf_dir)
    return sampling.except_distinct(wb.txn.select("name_orig", "type"), wb.balanced.select("name_orig", "type"))


# ============================================================== aggregations
@query("agg_stage_counts", O.with_base(None, """SELECT stage, isFraud, count(*) AS n FROM (
  SELECT 'input' AS stage, isFraud FROM txn UNION ALL SELECT 'balanced', isFraud FROM balanced
  UNION ALL SELECT 'train', isFraud FROM train UNION ALL SELECT 'test', isFraud FROM test) s
GROUP BY stage, isFraud"""))
def agg_stage_counts(spark, sf_dir):
    """Two passes: over the input, and over the balanced frame, of which train
    and test are filters counted side by side."""
    wb = _wb(spark, sf_dir)
    parts = wb.balanced.withColumn("is_train", sampling.train_mask(seed=wb.seed)).groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("balanced"), F.count_if("is_train").alias("train"), F.count_if(~F.col("is_train")).alias("test"))
    long = parts.unpivot([LABEL], ["balanced", "train", "test"], "stage", "n").filter("n > 0")
    whole = wb.txn.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"))
    return whole.select(F.lit("input").alias("stage"), LABEL, "n").unionByName(long.select("stage", LABEL, "n"))


@query("agg_group_rate", O.with_base(None, "SELECT type, round(avg(isFraud), 6) AS rate FROM train GROUP BY type"))
def agg_group_rate(spark, sf_dir):
    rates = anomaly.group_rates(_wb(spark, sf_dir).train, "type")
    return rates.select("type", F.round("rate", 6).alias("rate"))


_GROUP_CODE = f"coalesce(CAST({_ORD_CASE} AS INTEGER), {len(TYPE_ORDINALS)})"


@query("anomaly_pick_cluster", O.with_base(
    f"""r AS (SELECT {_GROUP_CODE} AS g, avg(isFraud) AS rate FROM train GROUP BY g)""",
    """SELECT CAST(coalesce((SELECT g FROM r WHERE rate >= 0.5 ORDER BY rate DESC, g ASC LIMIT 1), 0) AS INTEGER)
  AS fraud_cluster"""))
def anomaly_pick_cluster(spark, sf_dir):
    """Majority-class group among the type codes (unknown types form code 4)."""
    train = _wb(spark, sf_dir).train.withColumn(
        "g", F.coalesce(ordinal_encode("type"), F.lit(len(TYPE_ORDINALS))))
    return anomaly.pick_majority_group(anomaly.group_rates(train, "g"), "g")


# --------------------------------------------- nearest-class-centre detector
_SCALED = [f"s_{c}" for c in NUMERIC_FEATURES]


def _scaled_frames(spark, sf_dir):
    """Numeric features divided by their training sample std (the standard
    scaler's output, without vectors), for train and test."""
    wb = _wb(spark, sf_dir)
    sds = wb.train.agg(F.struct(*[F.stddev_samp(c).alias(c) for c in NUMERIC_FEATURES])).scalar()

    def scale(df):
        return df.select("txn_id", LABEL, *[(F.col(c) / sds[c]).alias(f"s_{c}") for c in NUMERIC_FEATURES])
    return scale(wb.train), scale(wb.test)


def _centre(df: DataFrame, label_value: float) -> DataFrame:
    """Mean scaled vector of one class as a one-row array."""
    return df.filter(F.col(LABEL) == label_value).agg(
        F.array(*[F.avg(c) for c in _SCALED]).alias("centre"))


_SCALED_SQL = (
    "sd AS (SELECT " + ", ".join(f"stddev_samp({c}) AS {c}" for c in NUMERIC_FEATURES) + " FROM train),\n"
    "strain AS (SELECT txn_id, isFraud, " + ", ".join(f"train.{c} / sd.{c} AS s_{c}" for c in NUMERIC_FEATURES)
    + " FROM train, sd),\n"
    "stest AS (SELECT txn_id, isFraud, " + ", ".join(f"test.{c} / sd.{c} AS s_{c}" for c in NUMERIC_FEATURES)
    + " FROM test, sd),\n"
    "c1 AS (SELECT " + ", ".join(f"avg(s_{c}) AS c_{c}" for c in NUMERIC_FEATURES)
    + " FROM strain WHERE isFraud = 1.0),\n"
    "c0 AS (SELECT " + ", ".join(f"avg(s_{c}) AS c_{c}" for c in NUMERIC_FEATURES)
    + " FROM strain WHERE isFraud = 0.0)")


def _sqdist_sql(src: str, ctr: str) -> str:
    return "(" + " + ".join(f"({src}.s_{c} - {ctr}.c_{c}) * ({src}.s_{c} - {ctr}.c_{c})"
                            for c in NUMERIC_FEATURES) + ")"


@query("anomaly_distance", O.with_base(_SCALED_SQL, f"""SELECT txn_id, round(-{_sqdist_sql('stest', 'c1')}, 6)
  AS rawPrediction FROM stest, c1"""), "ER")
def anomaly_distance(spark, sf_dir):
    """Negated squared distance of each test row to the fraud-class centre
    (built-in array expressions; the centre is a scalar subquery)."""
    train_s, test_s = _scaled_frames(spark, sf_dir)
    centre = _centre(train_s, 1.0).scalar()
    pts = F.array(*[F.col(c) for c in _SCALED])
    out = test_s.withColumn("centre", centre).select(
        "txn_id", F.round(anomaly.distance_score(pts, F.col("centre")), 6).alias("rawPrediction"))
    return out


@query("anomaly_remap", O.with_base(_SCALED_SQL + f""",
assign AS (SELECT s.txn_id, s.isFraud, s.side,
  CASE WHEN {_sqdist_sql('s', 'c1')} < {_sqdist_sql('s', 'c0')} THEN 1 ELSE 0 END AS cluster
  FROM (SELECT *, 'train' AS side FROM strain UNION ALL SELECT *, 'test' FROM stest) s, c0, c1),
r AS (SELECT cluster, avg(isFraud) AS rate FROM assign WHERE side = 'train' GROUP BY cluster),
pick AS (SELECT CAST(coalesce((SELECT cluster FROM r WHERE rate >= 0.5 ORDER BY rate DESC, cluster ASC LIMIT 1), 0)
  AS INTEGER) AS fc)""", """SELECT txn_id, CASE WHEN cluster = fc THEN 1 ELSE 0 END AS prediction
FROM assign, pick WHERE side = 'test'"""))
def anomaly_remap(spark, sf_dir):
    """Nearest class-centre clusters (0 = non-fraud centre, 1 = fraud centre),
    majority map learned on train, CASE remap applied to test."""
    train_s, test_s = _scaled_frames(spark, sf_dir)
    c1 = _centre(train_s, 1.0).scalar()
    c0 = _centre(train_s, 0.0).scalar()
    pts = F.array(*[F.col(c) for c in _SCALED])

    def assign(df):
        d = df.withColumn("c1", c1).withColumn("c0", c0)
        near = anomaly.distance_score(pts, F.col("c1")) > anomaly.distance_score(pts, F.col("c0"))
        return d.withColumn("cluster", near.cast("int"))
    fc = anomaly.pick_majority_group(anomaly.group_rates(assign(train_s), "cluster"), "cluster").scalar()
    return assign(test_s).select("txn_id", anomaly.remap_to_class("cluster", fc).alias("prediction"))


# ========================================================== feature pipeline
def _ohe_sql(width: int, idx_col: str = "type_index") -> str:
    return ", ".join(f"CAST({idx_col} = {float(i)} AS DOUBLE) AS f{5 + i}" for i in range(width))


@query("feat_string_index", O.with_base(O.type_index_cte(), "SELECT type, type_index FROM idx"))
def feat_string_index(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    model = StringIndexer(inputCol="type", outputCol="type_index").fit(wb.train)
    types = wb.train.select("type").distinct()
    return model.transform(types).select("type", "type_index")


@query("feat_string_index_keep", O.with_base(
    O.type_index_cte("(SELECT * FROM train WHERE isFraud = 1.0)", "idx")
    + ",\nnl AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM idx)",
    """SELECT test.txn_id, test.type, coalesce(idx.type_index, nl.n) AS type_index
FROM test LEFT JOIN idx ON test.type = idx.type, nl"""))
def feat_string_index_keep(spark, sf_dir):
    """Index fitted on the fraud rows of train (two types), applied to all test
    rows: unseen (and NULL) types get index = number of labels."""
    wb = _wb(spark, sf_dir)
    model = StringIndexer(inputCol="type", outputCol="type_index", handleInvalid="keep").fit(
        wb.train.filter(F.col(LABEL) == 1.0))
    return model.transform(wb.test).select("txn_id", "type", "type_index")


@query("feat_one_hot", O.with_base(O.type_index_cte(), f"""SELECT train.txn_id, {_ohe_sql(4)}
FROM train JOIN idx ON train.type = idx.type"""))
def feat_one_hot(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    fm = Pipeline(stages=feat.feature_stages()[:2]).fit(wb.train)
    out = fm.transform(wb.train)
    arr = vector_to_array("type_ohe")
    return out.select("txn_id", *[arr[i].alias(f"f{5 + i}") for i in range(4)])


@query("feat_one_hot_keep", O.with_base(
    O.type_index_cte("(SELECT * FROM train WHERE isFraud = 1.0)", "idx")
    + ",\nnl AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM idx)",
    f"""SELECT test.txn_id, {_ohe_sql(3, 'coalesce(idx.type_index, nl.n)')}
FROM test LEFT JOIN idx ON test.type = idx.type, nl"""))
def feat_one_hot_keep(spark, sf_dir):
    """Two-label index with ``keep``: one-hot width = labels + 1 (unseen slot)."""
    wb = _wb(spark, sf_dir)
    fm = Pipeline(stages=feat.feature_stages(keep_invalid=True)[:2]).fit(wb.train.filter(F.col(LABEL) == 1.0))
    arr = vector_to_array("type_ohe")
    return fm.transform(wb.test).select("txn_id", *[arr[i].alias(f"f{5 + i}") for i in range(3)])


_NUM_SQL = ", ".join(f"{c} AS f{i}" for i, c in enumerate(NUMERIC_FEATURES))


@query("feat_assemble", O.with_base(O.type_index_cte(), f"""SELECT test.txn_id, {_NUM_SQL}, {_ohe_sql(4)}
FROM test JOIN idx ON test.type = idx.type"""))
def feat_assemble(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    fm = Pipeline(stages=feat.feature_stages(scale=False, out="features_raw")).fit(wb.train)
    return feat.vector_columns(fm.transform(wb.test), "features_raw", 9)


_WIDE = NUMERIC_FEATURES + ["deltaOrig", "deltaDest", "balanceMismatch"]


@query("feat_assemble_wide", O.with_base(O.type_index_cte() + ",\nnl AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM idx),\n"
                                         """wt AS (SELECT *, oldbalanceOrg - newbalanceOrig AS deltaOrig,
  newbalanceDest - oldbalanceDest AS deltaDest,
  CAST(coalesce(abs((oldbalanceOrg - newbalanceOrig) - amount) > 0.01
       OR abs((newbalanceDest - oldbalanceDest) - amount) > 0.01, false) AS DOUBLE) AS balanceMismatch FROM test)""",
    "SELECT wt.txn_id, " + ", ".join(f"{c} AS f{i}" for i, c in enumerate(_WIDE)) + ", "
    + ", ".join(f"CAST(coalesce(idx.type_index, nl.n) = {float(i)} AS DOUBLE) AS f{8 + i}" for i in range(5))
    + "\nFROM wt LEFT JOIN idx ON wt.type = idx.type, nl"))
def feat_assemble_wide(spark, sf_dir):
    """8 numbers + one-hot with an unseen slot, ``handleInvalid=keep``."""
    wb = _wb(spark, sf_dir)
    stages = feat.feature_stages(wide=True, scale=False, out="features_raw")
    fm = Pipeline(stages=stages).fit(feat.with_balance_deltas(wb.train))
    return feat.vector_columns(fm.transform(feat.with_balance_deltas(wb.test)), "features_raw", 13)


_SD_ALL_SQL = (O.type_index_cte() + ",\n"
               + f"tr AS (SELECT train.txn_id, {_NUM_SQL}, {_ohe_sql(4)} FROM train JOIN idx ON train.type = idx.type),\n"
               + f"te AS (SELECT test.txn_id, {_NUM_SQL}, {_ohe_sql(4)} FROM test JOIN idx ON test.type = idx.type),\n"
               + "sd AS (SELECT " + ", ".join(f"stddev_samp(f{i}) AS d{i}" for i in range(9)) + " FROM tr)")
_SCALED_COLS_SQL = ", ".join(f"round(CASE WHEN d{i} = 0 THEN 0.0 ELSE f{i} / d{i} END, 6) AS f{i}" for i in range(9))


@query("feat_standard_scale", O.with_base(_SD_ALL_SQL, f"SELECT txn_id, {_SCALED_COLS_SQL} FROM te, sd"), "ER")
def feat_standard_scale(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    out = feat.vector_columns(wb.test_features(), "features", 9)
    return out.select("txn_id", *[F.round(f"f{i}", 6).alias(f"f{i}") for i in range(9)])


@query("feat_pipeline", O.with_base(_SD_ALL_SQL, f"""SELECT txn_id, 'train' AS side, {_SCALED_COLS_SQL} FROM tr, sd
UNION ALL SELECT txn_id, 'test' AS side, {_SCALED_COLS_SQL} FROM te, sd"""), "ER")
def feat_pipeline(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    parts = []
    for side, df in (("train", wb.train_features()), ("test", wb.test_features())):
        v = feat.vector_columns(df, "features", 9)
        parts.append(v.select("txn_id", F.lit(side).alias("side"),
                              *[F.round(f"f{i}", 6).alias(f"f{i}") for i in range(9)]))
    return parts[0].unionByName(parts[1])


# ===================================================================== PCA
_PCA_COLS = ("amount", "oldbalanceOrg")


@query("feat_pca_2d", O.with_base(
    f"""m AS (SELECT var_samp({_PCA_COLS[0]}) AS a, covar_samp({_PCA_COLS[0]}, {_PCA_COLS[1]}) AS b,
  var_samp({_PCA_COLS[1]}) AS c FROM txn),
e AS (SELECT a, b, c, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l1,
  (a + c) / 2 - sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l2 FROM m),
v AS (SELECT 0 AS component, l1 / (l1 + l2) AS ev, b AS x, l1 - a AS y FROM e
  UNION ALL SELECT 1, l2 / (l1 + l2), b, l2 - a FROM e),
n AS (SELECT component, ev, x / sqrt(x * x + y * y) AS x, y / sqrt(x * x + y * y) AS y FROM v),
s AS (SELECT component, ev, CASE WHEN (CASE WHEN abs(x) >= abs(y) THEN x ELSE y END) < 0 THEN -1.0 ELSE 1.0 END
  AS sg, x, y FROM n)""",
    """SELECT component, round(ev, 6) AS explained_variance, round(sg * x, 6) AS loading_0,
  round(sg * y, 6) AS loading_1 FROM s"""), "CF")
def feat_pca_2d(spark, sf_dir):
    """PCA(k=2) on two columns of unequal scale: explained variance and
    sign-normalised loadings per component."""
    txn = _wb(spark, sf_dir).txn
    va = VectorAssembler(inputCols=list(_PCA_COLS), outputCol="v")
    data = va.transform(txn)
    model = PCA(k=2, inputCol="v", outputCol="pc").fit(data)
    pc = model.pc.toArray()           # d x k model state (columns = components)
    comps = feat.normalise_pca_signs([[float(pc[r, k]) for r in range(2)] for k in range(2)])
    # explained variance = variance of each projection over the whole table
    proj = vector_to_array(F.col("pc"))
    var = model.transform(data).agg(*[F.var_samp(proj[k]).alias(f"v{k}") for k in range(2)])
    total = F.col("v0") + F.col("v1")
    rows = F.array(*[F.struct(F.lit(k).alias("component"), (F.col(f"v{k}") / total).alias("explained_variance"),
                              F.lit(comps[k][0]).alias("loading_0"), F.lit(comps[k][1]).alias("loading_1"))
                     for k in range(2)])
    out = var.select(F.inline(rows))
    return out.select("component", *[F.round(c, 6).alias(c) for c in ("explained_variance", "loading_0", "loading_1")])


_PCA_K, _PCA_N = 5, 9


def _pca_sql() -> str:
    """Components by repeated squaring: a covariance matrix, squared and scaled to trace 1
    again and again, becomes the projector on its first component, whose row of
    the largest diagonal element is the component with that loading positive.  The
    component is then taken out of the matrix, and the next one follows."""
    n = range(_PCA_N)
    xs = ", ".join(f"CASE WHEN d{i} = 0 THEN 0.0 ELSE f{i} / d{i} END AS x{i}" for i in n)
    cov = "[" + ", ".join("[" + ", ".join(f"covar_samp(x{i}, x{j})" for j in n) + "]" for i in n) + "]"
    trace = "list_sum(list_transform(range(1, {n}), lambda k: x[k][k]))".format(n=_PCA_N + 1)
    ctes = [_SD_ALL_SQL, f"xtr AS (SELECT {xs} FROM tr, sd)", f"xte AS (SELECT txn_id, {xs} FROM te, sd)", f"c0 AS (SELECT {cov} AS c FROM xtr)"]
    for k in range(_PCA_K):
        ctes.append(f"""q{k}(i, m) AS (SELECT 0, c FROM c{k} UNION ALL
  SELECT i + 1, list_transform(x, lambda r: list_transform(r, lambda e: e / t)) FROM (SELECT i, x, {trace} AS t FROM (
    SELECT i, list_transform(m, lambda r: list_transform(m, lambda s: list_dot_product(r, s))) AS x FROM q{k} WHERE i < 40)))""")
        ctes.append(f"p{k} AS (SELECT m, c, list_sum(list_transform(range(1, {_PCA_N + 1}), lambda r: list_dot_product(m[r], c[r]))) AS l "
                    f"FROM q{k}, c{k} WHERE i = 40)")
        ctes.append(f"v{k} AS (SELECT list_transform(m[j], lambda e: e / sqrt(m[j][j])) AS v FROM (SELECT m, list_position(d, list_max(d)) AS j "
                    f"FROM (SELECT m, list_transform(range(1, {_PCA_N + 1}), lambda r: m[r][r]) AS d FROM p{k})))")
        ctes.append(f"c{k + 1} AS (SELECT list_transform(range(1, {_PCA_N + 1}), lambda r: list_transform(range(1, {_PCA_N + 1}), "
                    f"lambda s: c[r][s] - l * m[r][s])) AS c FROM p{k})")
    row = "[" + ", ".join(f"x{i}" for i in n) + "]"
    select = "SELECT txn_id, " + ", ".join(f"round(list_dot_product({row}, v{k}.v), 4) + 0.0 AS pc{k}" for k in range(_PCA_K)) \
        + " FROM xte, " + ", ".join(f"v{k}" for k in range(_PCA_K))
    return O.with_base(",\n".join(ctes), select).replace("WITH ", "WITH RECURSIVE ", 1)


@query("feat_pca_k5", _pca_sql(), "CF")
def feat_pca_k5(spark, sf_dir):
    """PCA(k=5) projections of the test features, each component's sign fixed
    so that its largest-magnitude loading is positive."""
    wb = _wb(spark, sf_dir)
    model = wb.fitted("pca5", lambda: feat.pca_stage(_PCA_K).fit(wb.train_features()))
    pc = model.pc.toArray()                                  # d x k model state
    raw = [[float(pc[r, k]) for r in range(pc.shape[0])] for k in range(pc.shape[1])]
    flips = feat.pca_sign_flips(raw)
    out = feat.vector_columns(model.transform(wb.test_features()), "pcaFeatures", _PCA_K, prefix="pc")
    return out.select("txn_id", *[(F.round(F.col(f"pc{k}") * F.lit(flips[k]), 4) + 0.0).alias(f"pc{k}") for k in range(_PCA_K)])


# ============================================================= evaluation
@query("eval_confusion", O.with_base(f"sc AS ({_rule_scored_sql()})", """SELECT
  CAST(count_if(isFraud = 1.0 AND prediction = 1.0) AS BIGINT) AS tp, CAST(count_if(isFraud = 0.0 AND prediction = 0.0) AS BIGINT) AS tn,
  CAST(count_if(isFraud = 0.0 AND prediction = 1.0) AS BIGINT) AS fp, CAST(count_if(isFraud = 1.0 AND prediction = 0.0) AS BIGINT) AS fn
FROM sc"""))
def eval_confusion(spark, sf_dir):
    return ev.confusion(_rule_scored(_wb(spark, sf_dir).test))


@query("eval_confusion_by_type", O.with_base(f"sc AS ({_rule_scored_sql()})", """SELECT type,
  CAST(count_if(isFraud = 1.0 AND prediction = 1.0) AS BIGINT) AS tp, CAST(count_if(isFraud = 0.0 AND prediction = 0.0) AS BIGINT) AS tn,
  CAST(count_if(isFraud = 0.0 AND prediction = 1.0) AS BIGINT) AS fp, CAST(count_if(isFraud = 1.0 AND prediction = 0.0) AS BIGINT) AS fn
FROM sc GROUP BY type"""))
def eval_confusion_by_type(spark, sf_dir):
    return ev.confusion(_rule_scored(_wb(spark, sf_dir).test), by=["type"])


@query("eval_prf", O.with_base(f"""sc AS ({_rule_scored_sql()}),
cf AS (SELECT CAST(count_if(isFraud = 1.0 AND prediction = 1.0) AS BIGINT) AS tp, CAST(count_if(isFraud = 0.0 AND prediction = 0.0) AS BIGINT) AS tn,
  CAST(count_if(isFraud = 0.0 AND prediction = 1.0) AS BIGINT) AS fp, CAST(count_if(isFraud = 1.0 AND prediction = 0.0) AS BIGINT) AS fn FROM sc),
pr AS (SELECT tp, tn, fp, fn, {_prf_sql('cf')} FROM cf)""",
    f"""SELECT tp, tn, fp, fn, round(a_, {METRIC_DIGITS}) AS Accuracy, round(p_, {METRIC_DIGITS}) AS Precision,
  round(r_, {METRIC_DIGITS}) AS Recall,
  round(CASE WHEN p_ + r_ > 0 THEN 2.0 * p_ * r_ / (p_ + r_) ELSE 0.0 END, {METRIC_DIGITS}) AS F1 FROM pr"""), "ER")
def eval_prf(spark, sf_dir):
    out = ev.prf(ev.confusion(_rule_scored(_wb(spark, sf_dir).test)))
    return out.select("tp", "tn", "fp", "fn", *[F.round(m, METRIC_DIGITS).alias(m) for m in METRIC_NAMES[:4]])


@query("eval_roc_auc", O.with_base(f"sc AS ({_rule_scored_sql()}),\n" + O.auc_select("sc"),
                                   f"SELECT round(roc_auc, {METRIC_DIGITS}) AS roc_auc, n_pos, n_neg FROM auc"), "ER")
def eval_roc_auc(spark, sf_dir):
    a = ev.auc_exact(_rule_scored(_wb(spark, sf_dir).test), F.col("score"))
    return a.select(F.round("roc_auc", METRIC_DIGITS).alias("roc_auc"), "n_pos", "n_neg")


@query("eval_pr_auc", O.with_base(f"sc AS ({_rule_scored_sql()}),\n" + O.auc_select("sc"),
                                  f"SELECT round(pr_auc, {METRIC_DIGITS}) AS pr_auc, n_pos, n_neg FROM auc"), "ER")
def eval_pr_auc(spark, sf_dir):
    a = ev.auc_exact(_rule_scored(_wb(spark, sf_dir).test), F.col("score"))
    return a.select(F.round("pr_auc", METRIC_DIGITS).alias("pr_auc"), "n_pos", "n_neg")


@query("metrics_long", _metrics_long_sql(), "ER")
def metrics_long(spark, sf_dir):
    return _rules_long(spark, sf_dir)


_WIDE_COLS_SQL = ", ".join(f'max(CASE WHEN metric = \'{m}\' THEN value END) AS "{m}"' for m in METRIC_NAMES)


_METRIC_NO_SQL = "CASE metric " + " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(METRIC_NAMES)) \
    + " ELSE 0 END"


@query("metrics_summary", O.with_base(_rules_long_sql() + ",\n" + _MW2_SQL + ",\n" + _UNPIVOT_SQL,
                                      f"""SELECT DISTINCT model, position, 0 AS line_no, model || ':' AS line FROM long
UNION ALL SELECT model, position, {_METRIC_NO_SQL} AS line_no,
  '  ' || metric || ': ' || coalesce(printf('%.{METRIC_DIGITS}f', value), 'None') AS line FROM long"""))
def metrics_summary(spark, sf_dir):
    """The summary listing (model header, then one line per metric)."""
    return ev.summary_lines(_rules_long(spark, sf_dir), METRIC_DIGITS)


@query("metrics_wide", O.with_base(_rules_long_sql() + ",\n" + _MW2_SQL + ",\n" + _UNPIVOT_SQL,
                                   f"SELECT model, position, {_WIDE_COLS_SQL} FROM long GROUP BY model, position"), "ER")
def metrics_wide(spark, sf_dir):
    table = ev.metrics_table(_rules_scored(spark, sf_dir), score=F.col("score"))
    return table.select("model", "position", *[F.round(m, METRIC_DIGITS).alias(m) for m in METRIC_NAMES])


@query("select_best_model", O.with_base(_rules_long_sql() + ",\n" + _MW2_SQL + ",\n" + _UNPIVOT_SQL,
                                        """SELECT model AS best_model, value AS best_F1 FROM long
WHERE metric = 'F1' AND value IS NOT NULL ORDER BY value DESC, position ASC LIMIT 1"""))
def select_best_model(spark, sf_dir):
    return ev.select_best(metrics_wide(spark, sf_dir))


# ========================================================== closed-form models
def _type_only_stages(weight: bool = False):
    return [StringIndexer(inputCol="type", outputCol="type_index"),
            OneHotEncoder(inputCols=["type_index"], outputCols=["type_ohe"]),
            VectorAssembler(inputCols=["type_ohe"], outputCol="features")]


def _saturated_lr(wb):
    return wb.fitted("lr_saturated", lambda: Pipeline(stages=_type_only_stages() + [
        LogisticRegression(featuresCol="features", labelCol=LABEL, maxIter=100, tol=1e-12)]).fit(wb.train))


def _weighted_saturated_lr(wb):
    return wb.fitted("lr_weighted_saturated", lambda: Pipeline(stages=_type_only_stages() + [
        models.weighted_logistic_regression(max_iter=100, tol=1e-12)]).fit(feat.with_class_weights(wb.train)))


def _per_type(model, df: DataFrame, digits: int = 4) -> DataFrame:
    types = df.select("type").distinct()
    p = vector_to_array(F.col("probability"))[1]
    return model.transform(types).select("type", F.round(p, digits).alias("probability"))


@query("model_lr_saturated", O.with_base(None, "SELECT type, round(avg(isFraud), 4) AS probability FROM train "
                                         "GROUP BY type"), "CF")
def model_lr_saturated(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    return _per_type(_saturated_lr(wb), wb.train)


@query("model_lr_weighted", O.with_base(
    "w AS (SELECT CAST(count_if(isFraud = 0.0) AS BIGINT) AS n0, CAST(count_if(isFraud = 1.0) AS BIGINT) AS n1 FROM train),\n"
    "tw AS (SELECT type, isFraud, CASE WHEN isFraud = 0.0 THEN CAST(n0 + n1 AS DOUBLE) / (2.0 * n0) "
    "ELSE CAST(n0 + n1 AS DOUBLE) / (2.0 * n1) END AS wt FROM train, w)",
    "SELECT type, round(sum(wt * isFraud) / sum(wt), 4) AS probability FROM tw GROUP BY type"), "CF")
def model_lr_weighted(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    return _per_type(_weighted_saturated_lr(wb), wb.train)


@query("model_gbt_saturated", O.with_base(None, "SELECT type, CAST(avg(isFraud) > 0.5 AS INTEGER) AS prediction "
                                          "FROM train GROUP BY type"), "CF")
def model_gbt_saturated(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    model = wb.fitted("gbt_saturated", lambda: Pipeline(stages=_type_only_stages() + [
        GBTClassifier(featuresCol="features", labelCol=LABEL, maxIter=20, stepSize=0.5, seed=wb.seed)]).fit(wb.train))
    # boosting approaches the group rate from the prior side and never
    # reaches 0 or 1 for pure groups, so the class (rate > 0.5) is compared
    types = wb.train.select("type").distinct()
    return model.transform(types).select("type", F.col("prediction").cast("int").alias("prediction"))


def _rf_rule_frame(df: DataFrame) -> DataFrame:
    bucket = F.floor(F.col("amount") / F.lit(RF_RULE_BUCKET)).cast("double")
    return df.select("txn_id", bucket.alias("bucket"),
                     (bucket >= F.lit(RF_RULE_CUT)).cast("double").alias("rule_label"))


@query("model_rf_rule", O.with_base(None, f"""SELECT txn_id,
  CAST(CAST(floor(amount / {RF_RULE_BUCKET}) AS DOUBLE) >= {RF_RULE_CUT} AS INTEGER) AS prediction FROM test"""), "CF")
def model_rf_rule(spark, sf_dir):
    """A forest recovers a single-threshold rule exactly (no bootstrap, all
    features, every distinct value a split candidate)."""
    wb = _wb(spark, sf_dir)

    def fit():
        va = VectorAssembler(inputCols=["bucket"], outputCol="features")
        rf = RandomForestClassifier(featuresCol="features", labelCol="rule_label", numTrees=5, maxDepth=3,
                                    bootstrap=False, featureSubsetStrategy="all", maxBins=64, seed=wb.seed)
        return Pipeline(stages=[va, rf]).fit(_rf_rule_frame(wb.train))
    model = wb.fitted("rf_rule", fit)
    return model.transform(_rf_rule_frame(wb.test)).select("txn_id", F.col("prediction").cast("int").alias("prediction"))


@query("model_kmeans_1d", O.with_base(
    f"""x AS (SELECT amount / {KMEANS_1D_SCALE} AS x FROM txn),
g AS (SELECT x, count(*) AS n, sum(x) AS sx FROM x GROUP BY x),
c AS (SELECT x, sum(n) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS nl,
  sum(sx) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS sl FROM g),
t AS (SELECT sum(n) AS nt, sum(sx) AS st FROM g),
cand AS (SELECT x, nl, sl, nt - nl AS nr, st - sl AS sr FROM c, t WHERE nt - nl > 0),
best AS (SELECT sl / nl AS ml, sr / nr AS mr FROM cand
  ORDER BY CAST(nl AS DOUBLE) * nr * (sl / nl - sr / nr) * (sl / nl - sr / nr) DESC LIMIT 1)""",
    "SELECT 0 AS cluster_rank, round(ml, 2) AS centre FROM best UNION ALL SELECT 1, round(mr, 2) FROM best"), "CF")
def model_kmeans_1d(spark, sf_dir):
    """KMeans(k=2) on one column; centres ranked ascending.  The oracle is the
    exact 1-D optimum (best split of the sorted values)."""
    wb = _wb(spark, sf_dir)
    x = wb.txn.select((F.col("amount") / F.lit(KMEANS_1D_SCALE)).alias("x"))
    va = VectorAssembler(inputCols=["x"], outputCol="v")
    model = wb.fitted("kmeans_1d", lambda: KMeans(k=2, featuresCol="v", seed=wb.seed, maxIter=100,
                                                  tol=1e-9).fit(va.transform(x)))
    # centres at convergence are the means of the assigned points
    means = model.transform(va.transform(x)).groupBy("prediction").agg(F.avg("x").alias("c"))
    ranked = means.agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    rows = F.array(F.struct(F.lit(0).alias("cluster_rank"), F.col("lo").alias("centre")),
                   F.struct(F.lit(1).alias("cluster_rank"), F.col("hi").alias("centre")))
    return ranked.select(F.inline(rows)).select("cluster_rank", F.round("centre", 2).alias("centre"))


# ================================================================ full models
#: Score equations are checked to this size (mean of (p - y) x).
EQUATION_LIMIT = 1e-4


def _score_equations(pred: DataFrame, weight: Column, width: int) -> DataFrame:
    """Of a logistic regression at its optimum: per feature (-1: the intercept) the
    weighted mean of y x, and whether the one of p x equals it."""
    x, p = vector_to_array("features"), vector_to_array("probability")[1]
    rows = pred.select(F.col(LABEL).alias("y"), p.alias("p"), weight.alias("w"),
                       F.posexplode(F.concat(F.array(F.lit(1.0)), x)).alias("feature", "x"))
    means = rows.groupBy("feature").agg(*[(F.sum(F.col("w") * F.col(c) * F.col("x")) / F.sum("w")).alias(c) for c in ("y", "p")])
    return means.filter(F.col("feature") <= width).select(
        (F.col("feature") - 1).alias("feature"), F.round("y", 6).alias("label_moment"),
        (F.abs(F.col("p") - F.col("y")) < EQUATION_LIMIT).alias("equation_holds"))


def _moments_sql(rows: str, width: int, weight: str = "1.0") -> str:
    cols = ["1.0"] + [f"x{i}" for i in range(width)]
    return "\nUNION ALL ".join(f"SELECT {i - 1} AS feature, round(sum({weight} * isFraud * {c}) / sum({weight}), 6) AS label_moment, "
                               f"true AS equation_holds FROM {rows}" for i, c in enumerate(cols))


@query("model_lr_full", O.with_base(
    _SD_ALL_SQL + ",\nz AS (SELECT train.isFraud, " + ", ".join(f"CASE WHEN d{i} = 0 THEN 0.0 ELSE f{i} / d{i} END AS x{i}" for i in range(9))
    + " FROM tr JOIN train USING (txn_id), sd)", _moments_sql("z", 9)), "CF")
def model_lr_full(spark, sf_dir):
    """Logistic regression on all scaled features, run to convergence: its score
    equations hold on the training side."""
    wb = _wb(spark, sf_dir)
    model = wb.fitted("lr_converged", lambda: models.logistic_regression(max_iter=500, tol=1e-12).fit(wb.train_features()))
    return _score_equations(model.transform(wb.train_features()), F.lit(1.0), 9)


_WIDE_SD = ",\n".join([
    O.type_index_cte(), "nl AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM idx)",
    "cw AS (SELECT CAST(count_if(isFraud = 0.0) AS BIGINT) AS n0, CAST(count_if(isFraud = 1.0) AS BIGINT) AS n1 FROM train)",
    """wt AS (SELECT *, oldbalanceOrg - newbalanceOrig AS deltaOrig, newbalanceDest - oldbalanceDest AS deltaDest,
  CAST(coalesce(abs((oldbalanceOrg - newbalanceOrig) - amount) > 0.01
       OR abs((newbalanceDest - oldbalanceDest) - amount) > 0.01, false) AS DOUBLE) AS balanceMismatch,
  CASE WHEN isFraud = 0.0 THEN CAST(n0 + n1 AS DOUBLE) / (2.0 * n0) ELSE CAST(n0 + n1 AS DOUBLE) / (2.0 * n1) END AS w FROM train, cw)""",
    "wf AS (SELECT isFraud, w, " + ", ".join(f"{c} AS f{i}" for i, c in enumerate(_WIDE)) + ", "
    + ", ".join(f"CAST(coalesce(idx.type_index, nl.n) = {float(i)} AS DOUBLE) AS f{8 + i}" for i in range(5))
    + " FROM wt LEFT JOIN idx ON wt.type = idx.type, nl)",
    "wsd AS (SELECT " + ", ".join(f"stddev_samp(f{i}) AS d{i}" for i in range(13)) + " FROM wf)",
    "z AS (SELECT isFraud, w, " + ", ".join(f"CASE WHEN d{i} = 0 THEN 0.0 ELSE f{i} / d{i} END AS x{i}" for i in range(13)) + " FROM wf, wsd)"])


@query("model_linear_wide_weighted", O.with_base(_WIDE_SD, _moments_sql("z", 13, "w")), "CF")
def model_linear_wide_weighted(spark, sf_dir):
    """Wide features (balance deltas, unseen-type slot, NaN-keeping assembly),
    scaled, class-weighted binomial LR without regularisation, run to
    convergence: its weighted score equations hold on the training side."""
    wb = _wb(spark, sf_dir)
    model = wb.fitted("linear_wide_converged", lambda: models.full_pipeline(
        feat.feature_stages(wide=True), models.weighted_logistic_regression(max_iter=500, tol=1e-12)).fit(wb.wide_train()))
    return _score_equations(model.transform(wb.wide_train()), F.col(WEIGHT_COL), 13)


RULE_TYPES = ("TRANSFER", "CASH_OUT")      # model_rf_full: label = bucket >= 7 and one of these types
_RULE_TYPES_SQL = "coalesce(type IN (" + ", ".join(f"'{t}'" for t in RULE_TYPES) + "), false)"


@query("model_rf_full", O.with_base(None, f"""SELECT txn_id, CAST(CAST(floor(amount / {RF_RULE_BUCKET}) AS DOUBLE) >= {RF_RULE_CUT}
  AND {_RULE_TYPES_SQL} AS INTEGER) AS prediction FROM test"""), "CF")
def model_rf_full(spark, sf_dir):
    """The registry's forest (50 bagged trees of depth 10, random feature subsets)
    on a label made of two rules, which it must find exactly."""
    wb = _wb(spark, sf_dir)

    def rows(df: DataFrame) -> DataFrame:
        both = _rf_rule_frame(df).join(df.select("txn_id", "type"), "txn_id")
        listed = F.coalesce(F.col("type").isin(*RULE_TYPES), F.lit(False))
        return both.withColumn("listed", listed.cast("double")).withColumn("rule_label", F.col("rule_label") * F.col("listed"))

    def fit():
        assemble = VectorAssembler(inputCols=["bucket", "listed"], outputCol="features")
        return Pipeline(stages=[assemble, models.random_forest(seed=wb.seed, label="rule_label")]).fit(rows(wb.train))
    model = wb.fitted("rf_two_rules", fit)
    return model.transform(rows(wb.test)).select("txn_id", F.col("prediction").cast("int").alias("prediction"))


# ------------------------------------------------------- second-order boosting
FORM_BUCKET = 1000.0       # form rows: amount in whole thousands, balances left out (0)


def _form_rows(df: DataFrame, *keep: str) -> DataFrame:
    """Transactions as the scoring form's four fields."""
    thousands = F.floor(F.col("amount") / F.lit(FORM_BUCKET)).cast("double")
    return df.select(*keep, "type", thousands.alias("amount"), F.lit(0.0).alias("oldbalanceOrg"), F.lit(0.0).alias("newbalanceOrig"))


def _boost_sql(rounds: int, step: float) -> str:
    """CTEs up to ``boosted(b, c, p)``: stumps boosted by gradients and Hessians on two
    features, over their cells instead of rows.  A candidate is a cut and a side for the missing."""
    leaf = "-{s} * {g} / ({h} + 1.0)"
    gain = "0.5 * (e.lg * e.lg / (e.lh + 1.0) + (sg - e.lg) * (sg - e.lg) / (sh - e.lh + 1.0) - sg * sg / (sh + 1.0))"
    return f"""fr AS (SELECT txn_id, floor(amount / {FORM_BUCKET}) AS b, CAST({_ORD_CASE} AS DOUBLE) AS c, isFraud, 1 AS own FROM train
  UNION ALL SELECT txn_id, floor(amount / {FORM_BUCKET}), CAST({_ORD_CASE} AS DOUBLE), isFraud, 0 FROM test),
cells AS (SELECT row_number() OVER (ORDER BY b, c NULLS LAST) AS k, b, c, CAST(sum(own) AS DOUBLE) AS n, sum(own * isFraud) AS pos FROM fr GROUP BY b, c),
arr AS (SELECT list(n ORDER BY k) AS ns, list(pos ORDER BY k) AS ps, count(*) AS nk FROM cells),
vals AS (SELECT DISTINCT 0 AS f, b AS v FROM cells WHERE n > 0 AND b <> 0 UNION ALL SELECT DISTINCT 1, c FROM cells WHERE n > 0 AND c <> 0),
cut AS (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS t FROM vals),
cand AS (SELECT row_number() OVER (ORDER BY f, v, ml DESC) AS idx, f, t, ml FROM cut, (VALUES (true), (false)) z(ml) WHERE t IS NOT NULL OR NOT ml),
sides AS (SELECT idx, list(CASE WHEN x IS NULL OR x = 0 THEN ml ELSE t IS NULL OR x < t END ORDER BY k) AS l
  FROM (SELECT cand.*, k, CASE WHEN f = 0 THEN b ELSE c END AS x FROM cand, cells) GROUP BY idx),
cs AS (SELECT list({{'idx': idx, 'l': l}} ORDER BY idx) AS cs FROM sides),
boost(i, m) AS (SELECT 0, list_transform(ns, lambda z: 0.0::DOUBLE) FROM arr UNION ALL
  SELECT i + 1, list_transform(range(1, nk + 1), lambda k: m[k] + CASE
      WHEN best IS NULL OR best.gain <= 1e-6 THEN {leaf.format(s=step, g='sg', h='sh')}
      WHEN best.l[k] THEN {leaf.format(s=step, g='best.lg', h='best.lh')} ELSE {leaf.format(s=step, g='(sg - best.lg)', h='(sh - best.lh)')} END)
  FROM (SELECT i, m, nk, sg, sh, list_sort(list_transform(list_filter(sc, lambda e: e.lh >= 1 AND sh - e.lh >= 1),
      lambda e: {{'gain': {gain}, 'first': -e.idx, 'lg': e.lg, 'lh': e.lh, 'l': e.l}}), 'DESC')[1] AS best
    FROM (SELECT *, list_sum(g) AS sg, list_sum(h) AS sh, list_transform(cs, lambda a: {{'idx': a.idx, 'l': a.l,
        'lg': list_sum(list_transform(range(1, nk + 1), lambda k: CASE WHEN a.l[k] THEN g[k] ELSE 0.0 END)),
        'lh': list_sum(list_transform(range(1, nk + 1), lambda k: CASE WHEN a.l[k] THEN h[k] ELSE 0.0 END))}}) AS sc
      FROM (SELECT i, m, nk, cs,
          list_transform(range(1, nk + 1), lambda k: ns[k] / (1.0 + exp(-m[k])) - ps[k]) AS g,
          list_transform(range(1, nk + 1), lambda k: ns[k] / (1.0 + exp(-m[k])) * (1.0 - 1.0 / (1.0 + exp(-m[k])))) AS h
        FROM boost, arr, cs WHERE i < {rounds})))),
boosted AS (SELECT b, c, 1.0 / (1.0 + exp(-m[k])) AS p FROM cells, boost WHERE i = {rounds}),
scored AS (SELECT test.*, p FROM test JOIN boosted ON boosted.b = floor(amount / {FORM_BUCKET})
  AND boosted.c IS NOT DISTINCT FROM CAST({_ORD_CASE} AS DOUBLE))"""


def _recursive(body: str, select: str) -> str:
    return O.with_base(body, select).replace("WITH ", "WITH RECURSIVE ", 1)


def _stumps(wb, rounds: int, step: float):
    train = wb.train.select("txn_id", LABEL).join(_form_rows(wb.train, "txn_id"), "txn_id")
    return wb.fitted(f"stumps-{rounds}", lambda: models.form_pipeline(rounds=rounds, stepSize=step, maxDepth=1).fit(train))


_BOOST_COLUMNS = "round(p, 6) AS probability, CAST(p > 0.5 AS INTEGER) AS prediction"


def _boost_rows(pred: DataFrame, *keep: str) -> DataFrame:
    p = vector_to_array("probability")[1]
    return pred.select(*keep, F.round(p, 6).alias("probability"), F.col("prediction").cast("int").alias("prediction"))


@query("model_boosted_stump", _recursive(_boost_sql(1, 1.0), f"SELECT txn_id, {_BOOST_COLUMNS} FROM scored"), "CF")
def model_boosted_stump(spark, sf_dir):
    """One split, with the missing rows (zeros, unknown types) on the better side and leaves of -G / (H + 1)."""
    wb = _wb(spark, sf_dir)
    return _boost_rows(_stumps(wb, 1, 1.0).transform(_form_rows(wb.test, "txn_id")), "txn_id")


@query("model_gbt_full", _recursive(_boost_sql(50, 0.1), f"SELECT txn_id, {_BOOST_COLUMNS} FROM scored"), "CF")
def model_gbt_full(spark, sf_dir):
    """50 rounds of second-order boosting with the reference's shrinkage, on stumps."""
    wb = _wb(spark, sf_dir)
    return _boost_rows(_stumps(wb, 50, 0.1).transform(_form_rows(wb.test, "txn_id")), "txn_id")


@query("score_form_rows", _recursive(_boost_sql(50, 0.1), f"""SELECT type, floor(amount / {FORM_BUCKET}) AS amount, round(p, 4) AS probability,
  CAST(p > 0.5 AS INTEGER) AS prediction, CASE WHEN p > 0.5 THEN 'FRAUD' ELSE 'NOT FRAUD' END AS label_text FROM scored"""), "CF")
def score_form_rows(spark, sf_dir):
    """The scoring form's four fields alone (``FORM_SCHEMA``), scored by the form's model."""
    wb = _wb(spark, sf_dir)
    rows = _form_rows(wb.test).to(FORM_SCHEMA)
    return scoring.score_batch(_stumps(wb, 50, 0.1), rows, keep=("type", "amount"), digits=4).drop("probability_text")


# ------------------------------------------------------------ cluster detector
def _detector_1d(wb):
    """Detector on the amount alone (in thousands): (model, train, test)."""
    def points(df: DataFrame) -> DataFrame:
        x = df.select("txn_id", LABEL, (F.col("amount") / F.lit(KMEANS_1D_SCALE)).alias("x"))
        return VectorAssembler(inputCols=["x"], outputCol="features").transform(x)
    train, test = points(wb.train), points(wb.test)
    return wb.fitted("anomaly_1d", lambda: anomaly.fit_anomaly(train, k_pca=1, seed=wb.seed, maxIter=100, tol=1e-9)), train, test


def _detector_sql(mapped_on: str) -> str:
    """CTEs up to ``det(txn_id, isFraud, raw, prediction)``: the best split of the sorted training values."""
    x = f"amount / {KMEANS_1D_SCALE}"
    return f"""dg AS (SELECT {x} AS x, count(*) AS n, sum({x}) AS sx FROM train GROUP BY 1),
dc AS (SELECT x, sum(n) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS nl, sum(sx) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS sl FROM dg),
dt AS (SELECT sum(n) AS nt, sum(sx) AS st FROM dg),
db AS (SELECT sl / nl AS ml, (st - sl) / (nt - nl) AS mr FROM dc, dt WHERE nt - nl > 0
  ORDER BY CAST(nl AS DOUBLE) * (nt - nl) * (sl / nl - (st - sl) / (nt - nl)) * (sl / nl - (st - sl) / (nt - nl)) DESC LIMIT 1),
da AS (SELECT txn_id, isFraud, {x} AS x, abs({x} - ml) > abs({x} - mr) AS high, ml, mr FROM {mapped_on}, db),
dr AS (SELECT high, avg(isFraud) AS rate FROM da GROUP BY high),
df AS (SELECT high FROM dr ORDER BY rate DESC, high LIMIT 1),
det AS (SELECT test.txn_id, test.isFraud, -({x} - CASE WHEN high THEN mr ELSE ml END) * ({x} - CASE WHEN high THEN mr ELSE ml END) AS raw,
  CAST((abs({x} - ml) > abs({x} - mr)) = high AS INTEGER) AS prediction FROM test, db, df)"""


def _detected(wb, mapped_on: str) -> DataFrame:
    model, train, test = _detector_1d(wb)
    return anomaly.anomaly_predictions(model, test, train if mapped_on == "train" else test, fallback="highest")


_DETECTED_SQL = "SELECT txn_id, isFraud, round(raw, 4) + 0.0 AS rawPrediction, prediction FROM det"


def _detected_rows(pred: DataFrame) -> DataFrame:
    return pred.select("txn_id", LABEL, (F.round("rawPrediction", 4) + 0.0).alias("rawPrediction"), F.col("prediction").cast("int").alias("prediction"))


@query("model_anomaly", O.with_base(_detector_sql("train"), _DETECTED_SQL), "CF")
def model_anomaly(spark, sf_dir):
    """PCA -> KMeans from several starts -> clusters mapped to classes by the training labels -> distance
    score, on one column, where the optimum is known."""
    return _detected_rows(_detected(_wb(spark, sf_dir), "train"))


@query("model_anomaly_test_mapped", O.with_base(_detector_sql("test"), _DETECTED_SQL), "CF")
def model_anomaly_test_mapped(spark, sf_dir):
    """The original mapping: clusters mapped to classes with the test labels."""
    return _detected_rows(_detected(_wb(spark, sf_dir), "test"))


@query("results_json_roundtrip", O.with_base(_rules_long_sql() + ",\n" + _MW2_SQL + ",\n" + _UNPIVOT_SQL
                                             + """,\nbest AS (SELECT model AS best_model FROM long
  WHERE metric = 'F1' AND value IS NOT NULL ORDER BY value DESC, position ASC LIMIT 1)""",
                                             "SELECT best_model, model, metric, value FROM long, best"))
def results_json_roundtrip(spark, sf_dir):
    """Rule-scorer metrics written in the nested results shape
    ``{best_model, all_metrics}`` and read back as (model, metric, value)."""
    long = _rules_long(spark, sf_dir)
    path = files.scratch_dir(spark, "results")
    files.write_results_json(long.drop("position"), ev.select_best(ev.metrics_wide(long)), path)
    back = files.read_results_json(spark, path)
    return files.nested_metrics_to_long(back, keep=("best_model",))


def _by_rate(weighted: bool) -> str:
    w = "CASE WHEN isFraud = 0.0 THEN 0.5 / n0 ELSE 0.5 / n1 END" if weighted else "1.0"
    return (f"SELECT test.*, round(q.p, 4) AS score, CAST(coalesce(q.p > 0.5, false) AS DOUBLE) AS prediction FROM test LEFT JOIN "
            f"(SELECT type, sum({w} * isFraud) / sum({w}) AS p FROM train, lw GROUP BY type) q ON test.type = q.type")


_LEADERBOARD_SQL = [
    ("TypeLogistic", _by_rate(False)), ("WeightedTypeLogistic", _by_rate(True)),
    ("AnomalyDetector", "SELECT test.*, round(raw, 4) AS score, CAST(det.prediction AS DOUBLE) AS prediction FROM test JOIN det USING (txn_id)"),
    ("BoostedStump", "SELECT scored.* EXCLUDE (p), round(p, 4) AS score, CAST(p > 0.5 AS DOUBLE) AS prediction FROM scored"),
]


def _leaderboard_sql() -> str:
    body = ",\n".join(["lw AS (SELECT CAST(count_if(isFraud = 0.0) AS DOUBLE) AS n0, CAST(count_if(isFraud = 1.0) AS DOUBLE) AS n1 FROM train)",
                       _detector_sql("train"), _boost_sql(1, 1.0), _models_sql(_LEADERBOARD_SQL), _MW2_SQL, _UNPIVOT_SQL])
    return _recursive(body, f"SELECT model, position, {_WIDE_COLS_SQL} FROM long GROUP BY model, position")


@query("leaderboard", _leaderboard_sql(), "CF")
def leaderboard(spark, sf_dir):
    """A list of models fitted side by side and measured in one pass (model x
    metric); the models are ones whose optimum is known."""
    wb = _wb(spark, sf_dir)
    wb.train.count()
    lr, weighted, _, stump = side_by_side(spark, [
        ("lr", lambda: _saturated_lr(wb)), ("weighted", lambda: _weighted_saturated_lr(wb)),
        ("anomaly", lambda: _detector_1d(wb)), ("stump", lambda: _stumps(wb, 1, 1.0))])
    p = F.round(vector_to_array("probability")[1], 4)
    form = wb.test.select("txn_id", LABEL).join(_form_rows(wb.test, "txn_id"), "txn_id")
    scored = [lr.transform(wb.test).withColumn("score", p), weighted.transform(wb.test).withColumn("score", p),
              _detected(wb, "train").withColumn("score", F.round("rawPrediction", 4)), stump.transform(form).withColumn("score", p)]
    named = [(name, df) for (name, _), df in zip(_LEADERBOARD_SQL, scored)]
    table = ev.metrics_table(named, score=F.col("score"))
    return table.select("model", "position", *[F.round(m, METRIC_DIGITS).alias(m) for m in METRIC_NAMES])


# =================================================================== scoring
def _saturated_scored_sql() -> str:
    return O.with_base(_TYPE_RATE_CTE, """SELECT test.txn_id, round(rate.p, 4) AS probability,
  CAST(rate.p > 0.5 AS INTEGER) AS prediction,
  CASE WHEN rate.p > 0.5 THEN 'FRAUD' ELSE 'NOT FRAUD' END AS label_text,
  printf('%.4f', round(rate.p, 4)) AS probability_text
FROM test LEFT JOIN rate ON test.type = rate.type""")


@query("score_batch_linear", _saturated_scored_sql(), "CF")
def score_batch_linear(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    return scoring.score_batch(_saturated_lr(wb), wb.test, digits=4)


@query("model_save_load_score", _saturated_scored_sql(), "CF")
def model_save_load_score(spark, sf_dir):
    """Features + LR saved as one PipelineModel, loaded back, scoring test."""
    wb = _wb(spark, sf_dir)
    path = files.scratch_dir(spark, "model")
    models.save_model(_saturated_lr(wb), path)
    return scoring.score_batch(models.load_model(path), wb.test, digits=4)


@query("score_stream", _saturated_scored_sql(), "CF")
def score_stream(spark, sf_dir):
    """Test rows land as parquet files in the shared folder; a Structured
    Streaming query drains them through the fitted pipeline (availableNow,
    checkpointed) into a parquet sink, which is read back."""
    wb = _wb(spark, sf_dir)
    base = files.scratch_dir(spark, "stream")
    src, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    cols = ["txn_id", "type"] + NUMERIC_FEATURES
    wb.test.select(*cols).write.parquet(src)
    schema = spark.read.parquet(src).schema
    return scoring_stream.score_stream(spark, _saturated_lr(wb), src, sink, ckpt, schema, digits=4)


# =============================================================== explanation
def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_DETAILS_SQL = " || ', ' || ".join(
    f"'{c}: ' || coalesce({c if c == 'type' else f'printf({chr(39)}%.4f{chr(39)}, {c})'}, 'null')" for c in explain.DETAIL_FIELDS)


@query("explain_prompt_text", O.with_base(f"sc AS ({_rule_scored_sql()})", f"""SELECT txn_id, {_sql_text(explain.PROMPT_HEAD)}
  || {_sql_text(explain.PROMPT_STEP1)} || CASE WHEN prediction = 1 THEN 'FRAUD' ELSE 'NOT FRAUD' END || '.' || chr(10)
  || {_sql_text(explain.PROMPT_STEP2)} || {_sql_text(explain.PROMPT_STEP3)} || 'Transaction: {{' || {_DETAILS_SQL}
  || ', predicted_label: ' || CAST(CAST(prediction AS INTEGER) AS VARCHAR) || '}}' || chr(10) || chr(10)
  || {_sql_text(explain.PROMPT_TAIL)} AS prompt FROM sc WHERE prediction = 1"""))
def explain_prompt_text(spark, sf_dir):
    """Prompt text for every flagged test transaction, as a column."""
    scored = _rule_scored(_wb(spark, sf_dir).test)
    return explain.with_prompt(scored).select("txn_id", "prompt")


_REQUEST_SQL = (
    f"SELECT test.txn_id, {_sql_text(explain.REQUEST_HEAD)} || " + " || ".join(
        f"{_sql_text(label)} || coalesce(" + ("test.type" if c == "type" else f"printf('%.4f', {c})") + ", 'null') || chr(10)"
        for label, c in explain.REQUEST_FIELDS)
    + f" || {_sql_text(explain.REQUEST_PREDICTED)} || CASE WHEN rate.p > 0.5 THEN 'FRAUD' ELSE 'NOT FRAUD' END"
    + f" || {_sql_text(explain.REQUEST_PROBABILITY)} || coalesce(printf('%.4f', round(rate.p, 4)), 'null')"
    + f" || {_sql_text(explain.REQUEST_TAIL)} AS request FROM test LEFT JOIN rate ON test.type = rate.type")


@query("explain_request_text", O.with_base(_TYPE_RATE_CTE, _REQUEST_SQL))
def explain_request_text(spark, sf_dir):
    """The short explanation request of every test transaction, with its probability."""
    scored = _with_type_rate(_wb(spark, sf_dir)).withColumn("prediction", over_threshold("p")).withColumn("p", F.round("p", 4))
    return scored.select("txn_id", explain.request_text("prediction", "p").alias("request"))


_REASON_SQL = (
    "ctr AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in NUMERIC_FEATURES) + " FROM train WHERE isFraud = 0.0),\n"
    "sdv AS (SELECT " + ", ".join(f"stddev_samp({c}) AS d_{c}" for c in NUMERIC_FEATURES) + " FROM train),\n"
    f"sc AS ({_rule_scored_sql()}),\n"
    "contrib AS (" + " UNION ALL ".join(
        f"SELECT txn_id, '{c}' AS n, (sc.{c} - ctr.m_{c}) / sdv.d_{c} AS c FROM sc, ctr, sdv WHERE prediction = 1"
        for c in NUMERIC_FEATURES) + "),\n"
    "ranked AS (SELECT txn_id, n, row_number() OVER (PARTITION BY txn_id ORDER BY c DESC, n ASC) AS k "
    "FROM contrib WHERE c > 0),\n"
    "flagged AS (SELECT txn_id FROM sc WHERE prediction = 1)")


@query("explain_top3_reasons", O.with_base(_REASON_SQL, """SELECT f.txn_id,
  max(CASE WHEN k = 1 THEN n END) AS reason_1, max(CASE WHEN k = 2 THEN n END) AS reason_2,
  max(CASE WHEN k = 3 THEN n END) AS reason_3
FROM flagged f LEFT JOIN ranked r ON f.txn_id = r.txn_id GROUP BY f.txn_id"""))
def explain_top3_reasons(spark, sf_dir):
    """Up to three attributes furthest above the typical (non-fraud) training
    transaction, in training standard deviations, for each flagged row."""
    wb = _wb(spark, sf_dir)
    centre = wb.train.filter(F.col(LABEL) == 0.0).agg(
        F.struct(*[F.avg(c).alias(c) for c in NUMERIC_FEATURES])).scalar()
    spread = wb.train.agg(F.struct(*[F.stddev_samp(c).alias(c) for c in NUMERIC_FEATURES])).scalar()
    contrib = explain.linear_contributions(
        {c: 1.0 for c in NUMERIC_FEATURES},
        {c: centre[c] for c in NUMERIC_FEATURES},
        {c: spread[c] for c in NUMERIC_FEATURES})
    flagged = _rule_scored(wb.test).filter(F.col("prediction") == 1)
    # contributions are bound to columns first: lambdas cannot hold subqueries
    bound = flagged.select("txn_id", *[v.alias(f"c_{k}") for k, v in contrib.items()])
    reasons = bound.select("txn_id", explain.top_reasons(
        {k: F.col(f"c_{k}") for k in contrib}, 3).alias("r"))
    return reasons.select("txn_id", *[F.try_element_at("r", F.lit(k)).alias(f"reason_{k}") for k in (1, 2, 3)])


@query("explain_top3_reasons_lr", O.with_base(O.type_index_cte() + """,
lw AS (SELECT CAST(count_if(isFraud = 0.0) AS DOUBLE) AS n0, CAST(count_if(isFraud = 1.0) AS DOUBLE) AS n1 FROM train),
rate AS (SELECT type, sum(CASE WHEN isFraud = 1.0 THEN 0.5 / n1 ELSE 0.0 END) / sum(CASE WHEN isFraud = 0.0 THEN 0.5 / n0 ELSE 0.5 / n1 END) AS p
  FROM train, lw GROUP BY type),
base AS (SELECT idx.type, p FROM idx JOIN rate USING (type) ORDER BY type_index DESC LIMIT 1)""",
    """SELECT test.txn_id, CASE WHEN test.type <> base.type AND rate.p > base.p THEN 'type=' || test.type END AS reason_1,
  CAST(NULL AS VARCHAR) AS reason_2, CAST(NULL AS VARCHAR) AS reason_3
FROM test JOIN rate ON test.type = rate.type, base WHERE rate.p > 0.5"""), "CF")
def explain_top3_reasons_lr(spark, sf_dir):
    """Reason codes from a fitted (class-weighted) logistic regression: the three
    largest positive ``coef_j * x_j`` for every test row that the model flags.  On
    the types alone a coefficient is a difference of the group rates' logits."""
    wb = _wb(spark, sf_dir)
    model = _weighted_saturated_lr(wb)
    labels = model.stages[0].labels
    names = [f"type={t}" for t in labels[:-1]]      # one-hot drops the last label
    contrib = explain.model_contributions("features", model.stages[-1].coefficients.toArray().tolist(), names)
    flagged = scoring.transform_all(model, wb.test).filter((F.col("prediction") == 1.0) & F.col(scoring.SCORED))
    bound = flagged.select("txn_id", *[v.alias(f"c{i}") for i, v in enumerate(contrib.values())])
    reasons = bound.select("txn_id", explain.top_reasons(
        {n: F.col(f"c{i}") for i, n in enumerate(contrib)}, 3).alias("r"))
    return reasons.select("txn_id", *[F.try_element_at("r", F.lit(k)).alias(f"reason_{k}") for k in (1, 2, 3)])


@query("explain_next_action", O.with_base(_TYPE_RATE_CTE, """SELECT test.txn_id, round(rate.p, 4) AS probability,
  CASE WHEN rate.p >= 0.9 THEN 'hold transaction' WHEN rate.p >= 0.7 THEN 'ask customer'
       WHEN rate.p > 0.5 THEN 'investigate account' ELSE 'no action' END AS next_action
FROM test LEFT JOIN rate ON test.type = rate.type"""), "CF")
def explain_next_action(spark, sf_dir):
    wb = _wb(spark, sf_dir)
    scored = scoring.score_batch(_saturated_lr(wb), wb.test)
    return scored.select("txn_id", F.round("probability", 4).alias("probability"), explain.next_action("probability").alias("next_action"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: e.fn for k, e in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in CATALOG.items() if e.sql}

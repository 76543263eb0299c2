"""Explanation columns for scored transactions.

The reference sends one prompt per transaction to a hosted language model.
Here the text is produced as a column over whole tables (ready for any
downstream batch text job), plus deterministic reason codes and a suggested
next action; no network call is made.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import fixed, label_text
from ..sources.schema import NUMERIC_FEATURES

# ---------------------------------------------------------------------------
# Prompt wording (task lines as in the reference's prompt)
# ---------------------------------------------------------------------------
PROMPT_HEAD = ("You are a helpful fraud-detection assistant. "
               "Read the transaction below and in simple English do three short things:\n\n")
PROMPT_STEP1 = "1) One-line explanation why the model predicted: "
PROMPT_STEP2 = "2) List up to 3 attributes that look suspicious (amount, balances, type etc.).\n"
PROMPT_STEP3 = ("3) Suggest one short next action (e.g., hold transaction, ask customer, "
                "investigate account).\n\n")
PROMPT_TAIL = "Keep the answer short (max 120 words). Use clear bullet points or numbered lines."
REQUEST_HEAD = "A transaction is being checked for fraud.\n\nTransaction details:\n"
REQUEST_FIELDS = [("- Type: ", "type"), ("- Amount: ", "amount"), ("- Old Balance: ", "oldbalanceOrg"),
                  ("- New Balance: ", "newbalanceOrig")]
REQUEST_PREDICTED = "\nThe model predicted: "
REQUEST_PROBABILITY = "\nProbability: "
REQUEST_TAIL = "\n\nExplain in simple words why the model might classify it this way."
# ---------------------------------------------------------------------------

# Next-action bands over the fraud probability (our definition): lower bound, action.
ACTION_BANDS = [(0.9, "hold transaction"), (0.7, "ask customer"), (0.5, "investigate account")]
NO_ACTION = "no action"

DETAIL_FIELDS = ["type"] + NUMERIC_FEATURES


def transaction_details(fields: Sequence[str] = DETAIL_FIELDS, pred_col: str = "prediction") -> Column:
    """``{type: X, amount: 1.2300, ...}`` built by concatenation (4 decimals)."""
    parts = []
    for name in fields:
        c = F.col(name)
        v = c if name == "type" else fixed(c, 4)
        parts += [F.lit(f"{name}: "), F.coalesce(v, F.lit("null")), F.lit(", ")]
    parts += [F.lit("predicted_label: "), F.col(pred_col).cast("int").cast("string")]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def prompt_text(pred_col: str = "prediction", fields: Sequence[str] = DETAIL_FIELDS) -> Column:
    return F.concat(
        F.lit(PROMPT_HEAD), F.lit(PROMPT_STEP1), label_text(pred_col), F.lit(".\n"),
        F.lit(PROMPT_STEP2), F.lit(PROMPT_STEP3),
        F.lit("Transaction: "), transaction_details(fields, pred_col), F.lit("\n\n"),
        F.lit(PROMPT_TAIL))


def request_text(pred_col: str = "prediction", probability: str = "probability") -> Column:
    """The short text of a single request, with the probability (4 decimals)."""
    parts = [F.lit(REQUEST_HEAD)]
    for label, name in REQUEST_FIELDS:
        value = F.col(name) if name == "type" else fixed(F.col(name), 4)
        parts += [F.lit(label), F.coalesce(value, F.lit("null")), F.lit("\n")]
    return F.concat(*parts, F.lit(REQUEST_PREDICTED), label_text(pred_col), F.lit(REQUEST_PROBABILITY),
                    F.coalesce(fixed(F.col(probability), 4), F.lit("null")), F.lit(REQUEST_TAIL))


def with_prompt(df: DataFrame, pred_col: str = "prediction", only_flagged: bool = True) -> DataFrame:
    out = df.filter(F.col(pred_col) == 1) if only_flagged else df
    return out.withColumn("prompt", prompt_text(pred_col))


def top_reasons(contributions: Mapping[str, Column], k: int = 3) -> Column:
    """Names of up to ``k`` attributes with the largest positive contribution
    (ties: name ascending), as array<string>."""
    items = F.array(*[F.struct(c.cast("double").alias("c"), F.lit(n).alias("n"))
                      for n, c in contributions.items()])
    positive = F.filter(items, lambda x: x["c"] > 0)
    ordered = F.array_sort(positive, lambda l, r: F.when(l["c"] > r["c"], -1)
                           .when(l["c"] < r["c"], 1)
                           .when(l["n"] < r["n"], -1)
                           .when(l["n"] > r["n"], 1).otherwise(0))
    return F.transform(F.slice(ordered, 1, k), lambda x: x["n"])


def linear_contributions(coefs: Mapping[str, float | Column], centre: Mapping[str, float | Column],
                         scale: Mapping[str, float | Column]) -> dict[str, Column]:
    """coef_j * (x_j - centre_j) / scale_j for each named feature."""
    out = {}
    for n, w in coefs.items():
        w = w if isinstance(w, Column) else F.lit(float(w))
        c = centre[n] if isinstance(centre[n], Column) else F.lit(float(centre[n]))
        s = scale[n] if isinstance(scale[n], Column) else F.lit(float(scale[n]))
        out[n] = w * F.try_divide(F.col(n) - c, s)
    return out


def model_contributions(features_col: str, coefficients: Sequence[float],
                        names: Sequence[str]) -> dict[str, Column]:
    """coef_j * x_j over the model's own (scaled) feature vector; the
    coefficients are model state (one number per feature)."""
    from pyspark.ml.functions import vector_to_array

    x = vector_to_array(F.col(features_col))
    return {n: F.lit(float(w)) * x[j] for j, (n, w) in enumerate(zip(names, coefficients))}


def next_action(p: Column | str) -> Column:
    pc = F.col(p) if isinstance(p, str) else p
    expr = F.lit(NO_ACTION)
    for bound, action in reversed(ACTION_BANDS):
        cond = pc >= F.lit(bound) if bound != 0.5 else pc > F.lit(bound)
        expr = F.when(cond, F.lit(action)).otherwise(expr)
    return expr

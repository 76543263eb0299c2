"""Quality classifier: regularised quadratic discriminant over document statistics.

Document statistics (lengths, character and word shares, repetition) are taken
from the whole text and transformed to be nearly Gaussian.  For each class the
mean and covariance come from mergeable sums that Spark adds up over all
training rows; covariances are shrunk towards the pooled one and a scaled
identity and factored once (Cholesky).  A score is the logistic of the
difference of the two log densities, by Mahalanobis distances from the cached
factors, plus the log prior odds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import free_name, with_value, written

STATS = ("words", "word_length", "symbols", "exclamations", "capitals", "digits", "stops", "wide",
         "lines", "line_copies", "vocabulary", "short_words")
FOLDS = 5
SHRINK_POOLED = 0.1
SHRINK_IDENTITY = 0.05
THRESHOLD = 0.3


def _byte_classes() -> np.ndarray:
    """For each byte its class: 0 other, 1 space, 2 symbol, 3 ``!``, 4 capital, 5 digit, 6 stop, 7 wide."""
    out = np.zeros(256, np.uint8)
    for values, k in ((b" \t\n\x0b\x0c\r", 1), (b"#*$%&|<>", 2), (b"!", 3), (bytes(range(65, 91)), 4),
                      (bytes(range(48, 58)), 5), (b".,;:?", 6), (bytes(range(192, 256)), 7)):
        out[np.frombuffer(values, np.uint8)] = k
    return out


_CLASSES = _byte_classes()
_CHUNK = 1 << 24


def statistics(data: bytes | None) -> list[float]:
    """The transformed statistics of one UTF-8 text (null like empty)."""
    data = data or b""
    n = np.zeros(8, np.int64)
    for at in range(0, len(data), _CHUNK):
        n += np.bincount(_CLASSES[np.frombuffer(data, np.uint8, min(_CHUNK, len(data) - at), at)], minlength=8)
    words = data.split()
    kinds = set(words)
    seen, lines, copies, short = set(), 0, 0, 0
    for line in data.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            copies += line in seen
            seen.add(line)
    short = sum(1 for w in words if len(w) <= 3)
    w, chars = max(1, len(words)), max(1, len(data) - int(n[1]))
    return [np.log1p(len(words)), np.log(chars / w), np.log(n[2] / w + 0.01), np.log(n[3] / w + 0.01),
            np.log(n[4] / chars + 0.01), np.log(n[5] / chars + 0.01), np.log(n[6] / w + 0.02), np.sqrt(n[7] / chars),
            np.log(lines / w + 0.005), np.sqrt(copies / max(1, lines)), len(kinds) / w, np.sqrt(short / w)]


def with_statistics(docs: DataFrame, text: str = "text", out: str = "x") -> DataFrame:
    """``docs`` without ``text`` and with the statistics of it in ``out``."""
    def values(texts: list) -> pa.Array:
        return pa.array([[float(v) for v in statistics(t)] for t in texts], pa.list_(pa.float64()))

    return with_value(docs, text, values, out, ArrayType(DoubleType()), drop_text=True)


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text, modulo ``folds``, equals ``fold`` (null id: false)."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


def one_label(labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """``(id, label)``, one row an id: the largest label; null ids and labels go."""
    return (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
            .filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label")))


@dataclass
class Discriminant:
    """Two Gaussians; ``whiten`` holds the inverted Cholesky factors of their
    shrunk covariances, made once when fitted."""

    mean: np.ndarray
    whiten: np.ndarray
    log_det: np.ndarray
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        density = []
        for k in (0, 1):
            z = self.whiten[k] @ (x - self.mean[k]).T
            density.append(-0.5 * (z * z).sum(axis=0) - 0.5 * self.log_det[k])
        return 1.0 / (1.0 + np.exp(np.clip(-(density[1] - density[0] + self.log_odds), -700, 700)))


@dataclass
class Constant:
    """Stands in where the training rows have fewer than two classes."""

    value: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def class_sums(rows: DataFrame) -> list:
    """Per label the count, the sums and the sums of products of ``x``: at most one
    row a label, added up in the tasks first."""
    d = len(STATS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column(1).to_pylist(), np.float64).reshape(-1, d)
            y = np.asarray(batch.column(0))
            for k in np.unique(y):
                own = x[y == k]
                t = total.setdefault(int(k), [0, np.zeros(d), np.zeros((d, d))])
                t[0] += len(own)
                t[1] += own.sum(axis=0)
                t[2] += own.T @ own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([np.concatenate([[t[0]], t[1], t[2].ravel()]).tolist() for t in total.values()], pa.list_(pa.float64()))],
            ["label", "s"])

    partial = rows.select("label", "x").mapInArrow(run, "label int, s array<double>")
    size = 1 + d + d * d
    return partial.groupBy("label").agg(F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(size)]).alias("s")).collect()


def fit(rows: DataFrame, pooled: float = SHRINK_POOLED, identity: float = SHRINK_IDENTITY) -> Discriminant | Constant:
    """Fit on ``rows(label, x)``, labels 0 and 1.

    No rows give the constant score 0.5, a single class its label.
    """
    d = len(STATS)
    sums = {r.label: np.array(r.s) for r in class_sums(rows.filter("label in (0, 1)"))}
    if len(sums) < 2:
        return Constant(float(next(iter(sums), 0.5)))
    n = np.array([sums[k][0] for k in (0, 1)])
    mean = np.stack([sums[k][1:1 + d] / n[k] for k in (0, 1)])
    scatter = np.stack([sums[k][1 + d:].reshape(d, d) - n[k] * np.outer(mean[k], mean[k]) for k in (0, 1)])
    both = scatter.sum(axis=0) / n.sum()
    whiten, log_det = [], []
    for k in (0, 1):
        cov = (1 - pooled) * scatter[k] / n[k] + pooled * both
        cov = (1 - identity) * cov + identity * np.diag(np.diag(both) + 1e-4)
        low = np.linalg.cholesky(cov)
        whiten.append(np.linalg.inv(low))
        log_det.append(2 * np.log(np.diag(low)).sum())
    return Discriminant(mean, np.stack(whiten), np.array(log_det), float(np.log(n[1] / n[0])))


def trainable(rows: DataFrame, folds: int, fold: int) -> DataFrame:
    """The ``rows(id, ...)`` that have an id outside the held-out fold."""
    return rows.filter(F.col("id").isNotNull() & ~held_out(F.col("id"), folds, fold))


def labelled(rows: DataFrame, labels: DataFrame, id_col: str, label: str, folds: int, fold: int) -> DataFrame:
    """``rows(id, x)`` outside the held-out fold with their ``label``."""
    return trainable(rows, folds, fold).join(one_label(labels, id_col, label), "id")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
          folds: int = FOLDS, fold: int = 0) -> Discriminant | Constant:
    """Fit on the labelled rows of ``docs`` whose id is not in the held-out fold.

    Only their statistics are shuffled, never a text; held-out texts are not read
    into statistics at all.
    """
    rows = trainable(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), folds, fold)
    return fit(labelled(with_statistics(rows), labels, id_col, label, folds, fold))


def with_score(docs: DataFrame, model: Discriminant | Constant, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of ``text`` (0 to 1) in ``out``."""
    def values(texts: list) -> pa.Array:
        x = np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(STATS))
        return pa.array(model.score(x), pa.float64())

    return with_value(docs, text, values, out, DoubleType())


def with_scored(rows: DataFrame, model: Discriminant | Constant, out: str = "score") -> DataFrame:
    """``rows(..., x)`` with the score of the statistics ``x`` in their place."""
    keep = [f for f in rows.schema.fields if f.name != "x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten(), np.float64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), pa.array(model.score(x), pa.float64())],
                                             [*(f.name for f in keep), out])

    return rows.mapInArrow(run, StructType([*keep, StructField(out, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
             folds: int = FOLDS, fold: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """``(id, held_out, score, predicted)`` for every row of ``docs``.

    Learns from the labelled rows whose id is not in the held-out fold; nothing
    but the text enters a score.  Null and empty texts are scored by the same
    model on zero counts.  Repeated rows are scored, and counted in training, as
    often as they come; an id with several labels takes the largest.  Rows with
    a null id are scored and never trained on.  Texts are scored whole, however
    long.  An empty table gives no rows.  Extra columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    # the texts are read once: training and scoring share the table of statistics
    rows = written(with_statistics(rows), "document-statistics")
    model = fit(labelled(rows, labels, id_col, label, folds, fold))
    return with_scored(rows, model).select(
        "id", held_out(F.col("id"), folds, fold).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored at ``threshold`` or above, columns unchanged.

    Nulls, empty and very long texts and repeated rows are scored as in
    :func:`classify`; an empty table gives an empty one, and without labelled rows
    every score is 0.5, so all rows stay.  Columns may have any names.
    """
    score = free_name(docs, "score")
    scored = with_score(docs, train(docs, labels, id_col, text, label), text, score)
    return scored.filter(F.col(score) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])

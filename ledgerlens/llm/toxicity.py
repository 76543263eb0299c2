"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; the unlabelled set is drawn from all
texts, confirmed or not, so that the class prior holds in it; no text is ever
taken for a negative.  A linear classifier over the rates of words and word beginnings is
trained in numpy on the non-negative risk

    prior * E_pos[l(z, +)] + max(0, E_unl[l(z, -)] - prior * E_pos[l(z, -)])

with the logistic loss l and the class prior taken from the labelled rows.  When
the second term falls below zero the step goes against it, so a flexible model
can't make unlabelled toxic texts negative by heart.

Training uses a bounded sample (POSITIVES confirmed and UNLABELLED rows of all,
chosen by a hash of the id); scoring covers every whole text.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import utf8_values, with_value, written
from .quality import held_out, one_label

FOLDS, FOLD = 4, 2
POSITIVES, UNLABELLED = 4000, 16000
FEATURES = 4096
LEAST_DOCS = 3
STRONG = 1.0
#: A feature enters with this log-likelihood ratio; chance exceeds it about once in 1,000 features.
LEAST_EVIDENCE = 12.0
BEGINNINGS = (4, 5, 6)
EPOCHS, RATE, DECAY = 300, 0.1, 1e-3
THRESHOLD = 0.3

#: Lower-cases A-Z and turns ASCII punctuation, digits and controls into spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_CHUNK = 1 << 22
MEMO_WORDS = 300_000
#: A rate is occurrences per 100 words, with words added to every text so that
#: one word of a short text does not weigh like many of a long one.
PER, ADDED = 100.0, 30.0


def word_runs(data: bytes | None) -> Iterator[list[bytes]]:
    """The words of a whole text in runs of bounded size."""
    data = data or b""
    at = 0
    while at < len(data):
        end = at + _CHUNK
        if end < len(data):
            end = len(data) if (cut := data.find(b" ", end)) < 0 else cut
        yield data[at:end].translate(_FOLD).split()
        at = end


def features_of(word: bytes) -> list[bytes]:
    """The word, and the beginnings of a longer one with a ``^``."""
    return [word, *(b"^" + word[:k] for k in BEGINNINGS if len(word) > k)]


def rates(data: bytes | None) -> dict[bytes, float]:
    """The rate of every feature of a text."""
    words: Counter = Counter()
    for run in word_runs(data):
        words.update(run)
    out: dict[bytes, float] = defaultdict(float)
    scale = PER / (words.total() + ADDED)
    for word, n in words.items():
        for f in features_of(word):
            out[f] += n * scale
    return out


class _Memo(dict):
    """The weight of a word with its beginnings, worked out once; bounded."""

    def __init__(self, weights: dict[bytes, float]):
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= MEMO_WORDS:
            self.clear()
        get = self.weights.get
        self[word] = w = sum(get(f, 0.0) for f in features_of(word))
        return w


@dataclass
class Linear:
    """Weights by feature; without training data every score is the prior."""

    weights: dict[bytes, float]
    bias: float

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        memo = _Memo(self.weights)
        z = np.full(len(texts), self.bias)
        for i, t in enumerate(texts if self.weights else []):
            total, n = 0.0, 0
            for run in word_runs(t):
                total += sum(map(memo.__getitem__, run))
                n += len(run)
            z[i] += total * PER / (n + ADDED)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))


def risk(theta: np.ndarray, owner: np.ndarray, flat: np.ndarray, x: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """``(first term, second term, gradient to follow)`` of the non-negative risk with the
    logistic loss: prior * l+ of the positives, and l- of the unlabelled less prior * l- of
    the positives.  Where the second term is below zero the gradient is that of
    raising it."""
    n_texts, n_pos, n_unl = len(positive), positive.sum(), (~positive).sum()
    z = np.bincount(owner, theta[flat] * x, n_texts) + theta[-1]
    p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
    minus = np.logaddexp(0, z)                                  # l(z, -)
    rest = minus[~positive].mean() - prior * minus[positive].mean()
    down = np.where(positive, -prior * p / n_pos, p / n_unl)    # gradient of the second term
    g = down + np.where(positive, prior * (p - 1) / n_pos, 0.0) if rest >= 0 else -down
    return prior * np.logaddexp(0, -z[positive]).mean(), rest, np.append(np.bincount(flat, g[owner] * x, len(theta) - 1), g.sum())


def fit_pu(owner: np.ndarray, flat: np.ndarray, x: np.ndarray, positive: np.ndarray, n_features: int, prior: float,
           epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on the non-negative risk, from the
    entries (text number, feature number, rate) of the texts."""
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, epochs + 1):
        _, _, grad = risk(theta, owner, flat, x, positive, prior)
        grad[:-1] += decay * theta[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def evidence(p: Column, u: Column, n_pos: int, n_unl: int) -> Column:
    """Log-likelihood ratio of a feature in ``p`` of the positive and ``u`` of the
    unlabelled texts, against one share for both; 0 where positives have it less."""
    def fit(k: Column, n: int, share: Column) -> Column:
        return (F.when(k > 0, k * F.log(share)).otherwise(0.0)
                + F.when(k < n, (n - k) * F.log(1 - share)).otherwise(0.0))

    own, other, both = p / float(n_pos), u / float(n_unl), (p + u) / float(n_pos + n_unl)
    ratio = 2 * (fit(p, n_pos, own) + fit(u, n_unl, other) - fit(p, n_pos, both) - fit(u, n_unl, both))
    return F.when(own > 2 * other, ratio).otherwise(0.0)


def _some(rows: DataFrame, n: int) -> DataFrame:
    """Up to ``n`` different ``rows(id, h)``, ids in the order of a seeded hash."""
    return rows.distinct().orderBy(F.xxhash64(F.col("id"), F.lit("toxicity")), "id", "h").limit(n)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
          folds: int = FOLDS, fold: int = FOLD, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Linear:
    """Fit on rows whose id is not in the held-out fold: ``positives`` confirmed and
    ``unlabelled`` rows at most, each different id and text once however often it is repeated.

    Without confirmed or without other rows the score is constant: the share of
    toxic labels, 0.0 if there are none at all.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).filter(
        F.col("id").isNotNull() & ~held_out(F.col("id"), folds, fold)).withColumn("h", F.xxhash64("text"))
    known = one_label(labels, id_col, label).filter(~held_out(F.col("id"), folds, fold))
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum((F.col("label") == 1).cast("int")), F.lit(0))).first()
    prior = float(np.clip(toxic / n if n else 0.0, 0.0, 1.0))
    if not 0 < toxic:
        return Linear({}, float(np.log(1e-6)))
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    toxic_ids = known.filter("label = 1").select("id")
    ids = rows.select("id", "h")
    # both samples are bounded, so they may be broadcast
    chosen = _some(ids.join(toxic_ids, "id", "left_semi"), positives).withColumn("y", F.lit(1)).unionByName(
        _some(ids, unlabelled).withColumn("y", F.lit(0)))
    met = rows.join(F.broadcast(written(chosen, "toxicity-ids")), ["id", "h"])
    sample = written(met.groupBy("id", "h", "y").agg(F.any_value("text").alias("text")).select("y", "text"), "toxicity-sample")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(rates(t).items()) for t in utf8_values(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[f for f, _ in o] for o in found], pa.list_(pa.binary())),
                 pa.array([[int(r >= STRONG) for _, r in o] for o in found], pa.list_(pa.int32()))], ["y", "f", "s"])

    one = sample.mapInArrow(listed, "y int, f array<binary>, s array<int>")
    n_pos, n_unl = sample.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    if not n_pos or not n_unl:
        return Linear({}, float(np.log(prior / (1 - prior))))
    other = 1 - F.col("y")
    seen = one.select("y", F.explode(F.arrays_zip("f", "s")).alias("e")).groupBy("e.f").agg(
        F.sum("y").alias("p"), F.sum(other).alias("u"),
        F.sum(F.col("y") * F.col("e.s")).alias("ps"), F.sum(other * F.col("e.s")).alias("us"))
    # in any number, or often: an innocent word may stand in many texts once
    best = seen.filter(F.col("p") >= LEAST_DOCS).withColumn("gain", F.greatest(
        evidence(F.col("p"), F.col("u"), n_pos, n_unl), evidence(F.col("ps"), F.col("us"), n_pos, n_unl)))
    best = best.filter(F.col("gain") >= LEAST_EVIDENCE)
    vocabulary = [bytes(r.f) for r in best.orderBy(F.desc("gain"), "f").limit(FEATURES).collect()]
    if not vocabulary:
        return Linear({}, float(np.log(prior / (1 - prior))))
    number = {f: i for i, f in enumerate(vocabulary)}

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted((number[f], r) for f, r in rates(t).items() if f in number) for t in utf8_values(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[f for f, _ in o] for o in own], pa.list_(pa.int32())),
                                              pa.array([[r for _, r in o] for o in own], pa.list_(pa.float64()))], ["y", "f", "r"])

    # a fixed order of the rows gives the same sums in every run
    got = sample.mapInArrow(numbered, "y int, f array<int>, r array<double>").orderBy(F.xxhash64("y", "f", "r"), "y", "f", "r").toArrow()
    lists, values = got.column("f").combine_chunks(), got.column("r").combine_chunks()
    owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
    weights, bias = fit_pu(owner, np.asarray(lists.flatten()), np.asarray(values.flatten()), np.asarray(got.column("y")) == 1,
                           len(vocabulary), prior)
    return Linear({f: float(w) for f, w in zip(vocabulary, weights)}, bias)


def with_score(docs: DataFrame, model: Linear, text: str = "text", out: str = "score", drop_text: bool = False) -> DataFrame:
    """``docs`` with the toxicity of the whole ``text`` (0 to 1) in ``out``."""
    return with_value(docs, text, lambda texts: pa.array(model.scores(texts), pa.float64()), out, DoubleType(), drop_text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
             folds: int = FOLDS, fold: int = FOLD, threshold: float = THRESHOLD) -> DataFrame:
    """``(id, held_out, score, predicted)`` for every row of ``docs``.

    Nothing but the text enters a score.  Null and empty texts get the score of
    a text without known features.  Repeated rows are scored as often as they
    come; an id with several labels takes the largest; rows with a null id are
    scored and never trained on.  Texts are scored whole, however long.  An empty
    table gives no rows.  Extra columns are not read.
    """
    model = train(docs, labels, id_col, text, label, folds, fold)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    return with_score(rows, model, drop_text=True).select(
        "id", held_out(F.col("id"), folds, fold).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))

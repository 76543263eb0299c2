"""Derived frames and fitted models shared by the plans of one session.

``balanced`` is made on first use, written as a parquet table in the shared
``spark.checkpoint.dir`` and read back: model fits iterate over its descendants
many times, and a lost executor must not send them back through the scan and
the four-table join.  It is then dealt by ``txn_id`` and sorted inside each
partition.  How many partitions there are follows from the number of rows alone
(:func:`layout`), so tasks grow with the data, while what seeded bagging sees
depends neither on the cores nor on the layout of the input.  Feature frames
are persisted MEMORY_AND_DISK and released by ``close()``.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import sampling
from ..session import shared_dir
from ..sources import files
from ..sources.schema import DEFAULT_SEED
from ..sources.tables import txn_frame

#: Partitions of the training frame at least, and rows of one at most (seeded
#: bagging reads the layout, so it is made from the data and not from the cluster).
TRAIN_PARTITIONS = 16
ROWS_PER_PARTITION = 250_000


def layout(rows: int) -> int:
    """Partitions for so many training rows: 16, 32, 64, ... of ROWS_PER_PARTITION rows at most."""
    n = TRAIN_PARTITIONS
    while n * ROWS_PER_PARTITION < rows:
        n *= 2
    return n


class Workbench:
    def __init__(self, spark: SparkSession, sf_dir: str | None, seed: int = DEFAULT_SEED,
                 checkpoint: bool = True, txn: DataFrame | None = None,
                 train_partitions: int | None = None):
        """Either ``sf_dir`` (the driver's tables, through the ``txn``
        fixture) or ``txn`` (any labelled transaction frame with a unique or
        content key ``txn_id``).  ``train_partitions``: see :func:`layout`, its default."""
        self.spark, self.sf_dir, self.seed = spark, sf_dir, seed
        shared_dir(spark)
        self.txn = txn if txn is not None else txn_frame(spark, sf_dir)
        self.checkpoint, self.train_partitions = checkpoint, train_partitions
        self._memo: dict = {}
        self._locks: dict = {}
        self._persisted: list[DataFrame] = []
        self._lock = threading.RLock()

    @property
    def balanced(self) -> DataFrame:
        return self.memo("balanced", self._balanced)

    def _balanced(self) -> DataFrame:
        balanced = sampling.balance(self.txn, seed=self.seed)
        if self.checkpoint:
            path = files.scratch_dir(self.spark, "balanced")
            balanced.write.parquet(path)
            balanced = self.spark.read.parquet(path)
        order = [F.col(c) for c in ("txn_id", "type", "amount") if c in balanced.columns]
        n = self.train_partitions or layout(balanced.count())       # of a table: its files' footers
        dealt = balanced.repartition(n, "txn_id").sortWithinPartitions(*order)
        return self.persist(dealt)

    @property
    def train(self) -> DataFrame:
        return self._split()[0]

    @property
    def test(self) -> DataFrame:
        return self._split()[1]

    def _split(self) -> tuple[DataFrame, DataFrame]:
        return self.memo("split", lambda: sampling.split_train_test(self.balanced, seed=self.seed))

    def memo(self, key, build: Callable):
        """``build()`` once a key; other keys may be built at the same time."""
        with self._lock:
            own = self._locks.setdefault(key, threading.RLock())
        with own:
            if key not in self._memo:
                self._memo[key] = build()
            return self._memo[key]

    def persist(self, df: DataFrame) -> DataFrame:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._persisted.append(df)
        return df

    # -- the reference's feature pipeline (5 numbers + one-hot type, scaled)
    def feature_model(self) -> PipelineModel:
        return self.memo("features", lambda: feat.fit_features(self.train))

    def train_features(self) -> DataFrame:
        return self.memo("train_features", lambda: self.persist(self.feature_model().transform(self.train)))

    def test_features(self) -> DataFrame:
        return self.memo("test_features", lambda: self.persist(self.feature_model().transform(self.test)))

    def wide_train(self) -> DataFrame:
        """The training side with balance deltas and class weights, derived once for
        all passes of the wide linear model."""
        return self.memo("wide_train", lambda: self.persist(feat.with_class_weights(feat.with_balance_deltas(self.train))))

    def fitted(self, key, fit: Callable):
        return self.memo(("fitted", key), fit)

    def close(self) -> None:
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()
        self._memo.clear()
        self._locks.clear()


_BENCHES: dict = {}
_BENCH_LOCK = threading.Lock()


def workbench(spark: SparkSession, sf_dir: str, seed: int = DEFAULT_SEED) -> Workbench:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), seed)
    with _BENCH_LOCK:
        wb = _BENCHES.get(key)
        if wb is None:
            wb = _BENCHES[key] = Workbench(spark, sf_dir, seed)
        return wb


def register_workbench(spark: SparkSession, source: str, wb: Workbench, seed: int = DEFAULT_SEED) -> Workbench:
    """Make ``wb`` (e.g. built over a CSV input) the workbench for ``source``."""
    with _BENCH_LOCK:
        _BENCHES[(spark.sparkContext.applicationId, source.rstrip("/"), seed)] = wb
    return wb


def reset_workbenches() -> None:
    with _BENCH_LOCK:
        for wb in _BENCHES.values():
            wb.close()
        _BENCHES.clear()

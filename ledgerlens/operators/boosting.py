"""Second-order gradient boosting with a learned branch for missing values.

The boosted model of the reference job (logistic loss, zeros as missing, L2
regularised leaves), as aggregations: every feature is cut into bins once; a
level of a tree is one ``groupBy(node, feature, bin)`` over the rows' gradients
and Hessians, combined in the tasks, whose result is bounded by nodes x
features x bins and picks the splits on the driver.  A split sends the missing
rows (zero, NaN) to the side that gains more.

Rows with the same bins and label have the same margin in every round, so the
rounds go over these groups and their numbers of rows (never more groups than
rows), not over the rows.

Gradients are summed as whole numbers of a fixed step, so sums, and with them
splits, depend neither on the order nor on the partitions of the rows, and a
group's is its number of rows times one row's.  The groups' margins are brought
up to date, as a table in the shared folder, every CUT_ROUNDS rounds; the trees
since then are evaluated with each pass.
"""

from __future__ import annotations

import json
import sys

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import files
from ..sources.schema import BOOST_MAX_DEPTH, BOOST_ROUNDS, BOOST_STEP, LABEL

MAX_BINS = 64
#: A smaller gain is noise.
LEAST_GAIN = 1e-6
CUT_ROUNDS = 10
_TREE = "struct<feature:array<int>, cut:array<double>, missing_left:array<boolean>, left:array<int>, right:array<int>, value:array<double>>"


class Tree:
    """Nodes by number; ``feature`` -1 is a leaf.  ``cut`` is a bin while growing
    (left: at most that bin) and a value afterwards (left: below it)."""

    def __init__(self):
        self.feature, self.cut, self.missing_left, self.left, self.right, self.value = [-1], [0.0], [False], [0], [0], [0.0]

    def split(self, node: int, feature: int, cut: float, missing_left: bool) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.cut[node], self.missing_left[node], self.left[node], self.right[node] = feature, cut, missing_left, a, a + 1
        for values, empty in ((self.feature, -1), (self.cut, 0.0), (self.missing_left, False), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            values += [empty, empty]
        return a, a + 1


def _literal(trees: list[Tree]) -> Column:
    return F.from_json(F.lit(json.dumps([vars(t) for t in trees])), f"array<{_TREE}>")


def _leaf(tree: Column, depth: int, below, missing) -> Column:
    """Number of the node that a row reaches: ``below(feature, cut)`` and
    ``missing(feature)`` test the row's value of a feature."""
    def step(at, _):
        feature = F.get(tree["feature"], at)
        left = F.when(missing(feature), F.get(tree["missing_left"], at)).otherwise(below(feature, F.get(tree["cut"], at)))
        return F.when(feature < 0, at).when(left, F.get(tree["left"], at)).otherwise(F.get(tree["right"], at))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(0), step)


def _binned_leaf(tree: Column, depth: int) -> Column:
    return _leaf(tree, depth, lambda f, cut: F.get("bins", f) <= cut, lambda f: F.get("bins", f) == 0)


def margin_of(values: Column, trees: Column, depth: int) -> Column:
    """Sum of the leaves that a row with the array ``values`` reaches."""
    def missing(feature):
        x = F.get(values, feature)
        return x.isNull() | F.isnan(x) | (x == 0)

    return F.aggregate(trees, F.lit(0.0), lambda total, tree: total + F.get(
        tree["value"], _leaf(tree, depth, lambda feature, cut: F.get(values, feature) < cut, missing)))


class _Columns(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column (0 or 1)", TypeConverters.toString)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol=LABEL, maxDepth=BOOST_MAX_DEPTH)


class SecondOrderBoostingModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds rawPrediction, probability (vectors of two classes) and prediction."""

    trees = Param(Params._dummy(), "trees", "the trees as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = vector_to_array(F.col(self.getOrDefault("featuresCol")))
        trees = F.from_json(F.lit(self.getOrDefault("trees")), f"array<{_TREE}>")
        margin = margin_of(values, trees, self.getOrDefault("maxDepth"))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        return (dataset.withColumn("rawPrediction", array_to_vector(F.array(-margin, margin)))
                .withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))
                .withColumn("prediction", (vector_to_array("probability")[1] > 0.5).cast("double")))


class SecondOrderBoosting(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """``rounds`` trees of ``maxDepth`` levels; a leaf is ``-stepSize * G / (H + l2)``.

    Splits need Hessians of at least ``minChildWeight`` on both sides.  A feature
    with at most ``maxBins`` different values is cut between all of them, another
    one at quantiles.  Rows whose label is neither 0 nor 1 are left out.
    """

    rounds = Param(Params._dummy(), "rounds", "number of trees", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "shrinkage of the leaves", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "L2 regularisation of the leaves", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least Hessian of a side", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature besides the missing one", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol=LABEL, maxDepth=BOOST_MAX_DEPTH, rounds=BOOST_ROUNDS,
                 stepSize=BOOST_STEP, l2=1.0, minChildWeight=1.0, maxBins=MAX_BINS):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(featuresCol=featuresCol, labelCol=labelCol, maxDepth=maxDepth, rounds=rounds, stepSize=stepSize,
                         l2=l2, minChildWeight=minChildWeight, maxBins=maxBins)

    # -- bins
    def _cuts(self, rows: DataFrame, width: int) -> list[list[float]]:
        """Per feature the rising values that begin a bin (the first bin begins at the least value)."""
        bins = self.getOrDefault("maxBins")
        x = [F.when((F.col(f"x{i}") != 0) & ~F.isnan(f"x{i}"), F.col(f"x{i}")) for i in range(width)]
        about = rows.agg(*[F.approx_count_distinct(c, 0.02).alias(f"n{i}") for i, c in enumerate(x)]).first()
        few = [about[f"n{i}"] <= bins for i in range(width)]      # so the set below has about as many values at most
        probs = [i / bins for i in range(1, bins)]
        made = rows.agg(*[(F.array_sort(F.collect_set(c)) if few[i] else F.array_distinct(F.percentile_approx(c, probs, 20 * bins))).alias(f"c{i}")
                          for i, c in enumerate(x)]).first()
        return [[float(v) for v in (made[f"c{i}"] or [])][1 if few[i] else 0:] for i in range(width)]

    def _fit(self, dataset: DataFrame) -> SecondOrderBoostingModel:
        spark = dataset.sparkSession
        label, depth = F.col(self.getOrDefault("labelCol")).cast("double"), self.getOrDefault("maxDepth")
        values = vector_to_array(F.col(self.getOrDefault("featuresCol")))
        first = dataset.select(F.size(values).alias("n")).first()
        if first is None:
            raise ValueError("no rows to fit on")
        width = first.n
        rows = dataset.filter(label.isin(0.0, 1.0)).select(label.alias("y"), *[values[i].alias(f"x{i}") for i in range(width)])
        cuts = self._cuts(rows, width)
        state = self._table(self._groups(rows, cuts))
        # the finest step at which no sum of so many gradients overflows
        scale = float(2 ** min(40, 62 - max(1, state.agg(F.sum("n")).first()[0] or 0).bit_length()))
        trees: list[Tree] = []
        held = state.persist(StorageLevel.MEMORY_AND_DISK)
        since: list[Tree] = []
        for r in range(self.getOrDefault("rounds")):
            if len(since) == CUT_ROUNDS:
                state = self._table(held.withColumn("margin", self._margin(since, depth)))
                held.unpersist()
                held, since = state.persist(StorageLevel.MEMORY_AND_DISK), []
            since.append(self._grow(held.withColumn("margin", self._margin(since, depth)), cuts, depth, scale))
            trees.append(since[-1])
        held.unpersist()
        for tree in trees:                                          # from bins to values; JSON has no infinity
            for i, f in enumerate(tree.feature):
                if f >= 0:
                    at = int(tree.cut[i])
                    tree.cut[i] = cuts[f][at - 1] if at <= len(cuts[f]) else sys.float_info.max
        model = SecondOrderBoostingModel()
        return model._set(featuresCol=self.getOrDefault("featuresCol"), labelCol=self.getOrDefault("labelCol"), maxDepth=depth,
                          trees=json.dumps([vars(t) for t in trees]))

    def _groups(self, rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
        """A row per label and bins, with the number ``n`` of such rows; counted in the tasks first."""
        bins = F.array(*[self._bin(F.col(f"x{i}"), c) for i, c in enumerate(cuts)])
        return (rows.select("y", bins.alias("bins")).groupBy("y", "bins").agg(F.count(F.lit(1)).alias("n"))
                .withColumn("margin", F.lit(0.0)))

    @staticmethod
    def _margin(trees: list[Tree], depth: int) -> Column:
        """The column ``margin`` and the leaves of ``trees`` that a group's bins reach."""
        if not trees:
            return F.col("margin")
        leaves = F.aggregate(_literal(trees), F.lit(0.0), lambda total, tree: total + F.get(tree["value"], _binned_leaf(tree, depth)))
        return F.col("margin") + leaves

    @staticmethod
    def _table(df: DataFrame) -> DataFrame:
        path = files.scratch_dir(df.sparkSession, "boosting")
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)

    @staticmethod
    def _bin(x: Column, cuts: list[float]) -> Column:
        """0: missing; else 1 and the number of cuts that are not above the value, in halving steps."""
        bounds = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<double>")
        steps = F.array(*[F.lit(1 << i) for i in range(max(1, len(cuts)).bit_length() - 1, -1, -1)])
        found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
            (at + step <= F.size(bounds)) & (F.get(bounds, at + step - 1) <= x), at + step).otherwise(at))
        return F.when(x.isNull() | F.isnan(x) | (x == 0), F.lit(0)).otherwise(found + 1)

    # -- one tree
    def _grow(self, state: DataFrame, cuts: list[list[float]], depth: int, scale: float) -> Tree:
        step, l2 = self.getOrDefault("stepSize"), self.getOrDefault("l2")
        tree, level = Tree(), [0]
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
        g, h = F.round((p - F.col("y")) * scale).cast("long"), F.round(p * (1 - p) * scale).cast("long")
        rows = state.withColumn("g", g * F.col("n")).withColumn("h", h * F.col("n"))
        sums: dict[int, tuple[float, float]] = {}
        for d in range(max(1, depth)):
            if not level:
                break
            node = _binned_leaf(F.get(_literal([tree]), F.lit(0)), d) if d else F.lit(0)
            there = rows.withColumn("node", node).filter(F.col("node").isin(level))
            found = (there.select("node", "g", "h", F.posexplode("bins").alias("feature", "bin"))
                     .groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())
            hist = {n: [np.zeros((2, len(c) + 2)) for c in cuts] for n in level}
            for r in found:
                hist[r["node"]][r["feature"]][:, r["bin"]] = (r["g"] / scale, r["h"] / scale)
            deeper = []
            for n in level:
                sums[n] = tuple(hist[n][0].sum(axis=1))
                best = self._best(hist[n], sums[n]) if depth else None
                if best is not None:
                    feature, cut, missing_left, left, right = best
                    a, b = tree.split(n, feature, float(cut), missing_left)
                    sums[a], sums[b] = left, right
                    deeper += [a, b]
            level = deeper
        for n, f in enumerate(tree.feature):
            if f < 0:
                g, h = sums.get(n, (0.0, 0.0))
                tree.value[n] = -step * g / (h + l2)
        return tree

    def _best(self, hist: list[np.ndarray], total: tuple[float, float]):
        """``(feature, bin, missing left, sums left, sums right)`` of the largest gain; the
        first by feature, bin and missing rows to the left among equals."""
        l2, least = self.getOrDefault("l2"), self.getOrDefault("minChildWeight")
        g, h = total
        best, most = None, LEAST_GAIN
        for feature, both in enumerate(hist):
            (mg, mh), left = both[:, 0], np.cumsum(both[:, 1:], axis=1)
            for b in range(left.shape[1]):
                for missing_left in (True, False):
                    if missing_left and b == left.shape[1] - 1:
                        continue                                     # nothing would go right
                    lg, lh = left[0, b] + (mg if missing_left else 0.0), left[1, b] + (mh if missing_left else 0.0)
                    rg, rh = g - lg, h - lh
                    if lh < least or rh < least:
                        continue
                    gain = 0.5 * (lg * lg / (lh + l2) + rg * rg / (rh + l2) - g * g / (h + l2))
                    if gain > most:
                        best, most = (feature, b + 1, missing_left, (lg, lh), (rg, rh)), gain
        return best

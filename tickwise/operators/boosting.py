"""Boosted trees over binned rows, as Spark ML's GBT fits them.

Spark's own fit keeps a row as an object and touches it feature by feature at
every level of every tree. Here rows are binned once into blocks of bytes, those
alike in every bin are added up as one weighted row (``cells``), and a level is
one job of NumPy histograms. The rules are Spark's: the first tree learns the
label, the others the negative gradient of squared or log loss times the step;
splits by the reduction of variance among at most 32 bins a feature, the first
of equal ones; leaves hold means, equal twins are merged. The fitted model is
Spark's own class. Bins are cut by all rows, where Spark looks at about 10,000.

Rows alike in every bin get the same score in every round, so their sums, and
with them splits and leaves, are those of the single rows. Rounds that draw rows
(``subsample``) go over single rows, each drawn by itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, inf, isfinite, nextafter

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bounded_values, cut_lineage

#: Training rows of a boosted model that a task goes through.
TASK_ROWS = 250_000
#: Bins of a feature, as Spark's trees have them.
MAX_BINS = 32
#: Rows up to which the bins come from all values, and values of a feature that are counted one by one beyond.
ALL_ROWS, COUNTED_VALUES = 10_000, 2_000
BIN_BITS, KEY_BINS = 6, 10
#: Sums that a task holds at once for the nodes of a level; parts of a job from which their sums are added up in tasks.
HELD_SUMS, MANY_PARTS = 4_000_000, 64
#: Impurity of a node that counts as none, share of a gain that counts as equal.
EPSILON, TIE = 2.220446049250313e-16, 1e-10


@dataclass
class Cells:
    """Binned training rows in blocks: (n, bins, rows, mean target, rows of class 1),
    ``added`` up by bins or single. Bin b of feature j holds values up to ``cuts[j][b]``."""
    blocks: DataFrame
    cuts: list[list[float]]
    n: int
    added: bool


def _cuts(values: list[tuple[float, float]]) -> list[float]:
    """Where Spark's trees cut a feature of these sorted (value, rows): between
    all values, if the bins suffice, else where the count is nearest to each 32nd."""
    total = sum(n for _, n in values)
    splits = min(MAX_BINS, int(total)) - 1
    middle = [(a + b) / 2.0 for (a, _), (b, _) in zip(values, values[1:])]
    if len(middle) <= splits:
        return middle
    out, seen, stride = [], values[0][1], total / (splits + 1)
    target = stride
    for cut, (_, n) in zip(middle, values[1:]):
        if abs(seen - target) < abs(seen + n - target):
            out.append(cut)
            target += stride
        seen += n
    return out


def categorical(train: DataFrame, features: str) -> bool:
    """Whether Spark's trees would read a feature as categories, by its attributes."""
    attrs = train.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return bool(attrs.get("nominal") or attrs.get("binary"))


def feature_cuts(train: DataFrame, features: str) -> tuple[list[list[float]], int]:
    """Cuts of every feature by all rows, exact where values are few, else by a
    sketch with a rank error of 1 in 1,000; and the number of rows."""
    x = vector_to_array(features)
    size = train.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
    if not size:
        first = train.select(F.size(x)).first()
        size = first[0] if first else 0
    of = train.select(x.alias("x"))
    at = [F.col("x")[j] for j in range(size)]
    probabilities = [i / MAX_BINS for i in range(1, MAX_BINS)]
    n, known, *told = of.agg(F.count(F.lit(1)), F.count("x"), *[F.max(F.abs(c)) for c in at], *[F.approx_count_distinct(c) for c in at],
                             *[F.percentile_approx(c, probabilities, 1000) for c in at]).first()
    if not n:
        raise ValueError("boosted trees need training rows")
    if known < n or not all(v is not None and isfinite(v) for v in told[:size]):
        raise ValueError(f"{features}: vectors must not be null, their values neither NaN nor infinite")
    cuts = [sorted(set(q)) for q in told[2 * size:]]
    counted = [j for j in range(size) if n <= ALL_ROWS or told[size + j] <= COUNTED_VALUES]
    if counted:
        values = of.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), (at[j] + 0.0).alias("v")) for j in counted])).alias("s"))
        values = values.groupBy("s.j", "s.v").count()
        found = {j: [] for j in counted}
        for j, v, rows in bounded_values(values, max(ALL_ROWS, 2 * COUNTED_VALUES) * len(counted), f"values of {features}"):
            found[j].append((v, rows))
        for j in counted:
            cuts[j] = _cuts(sorted(found[j]))
    return cuts, int(n)


def cells(train: DataFrame, features: str, target: str | None = None, classes: str | None = None, *, added: bool = True,
          like: Cells | None = None) -> Cells:
    """``train`` for any number of fits: two passes find the bins (or they are those
    of ``like``, of the same rows), one adds up the rows of each bin pattern."""
    cuts, n = (like.cuts, like.n) if like else feature_cuts(train, features)
    d, names = len(cuts), [f"__x{j}" for j in range(len(cuts))]
    labels = [F.col(target).cast("double").alias("__y")] if target else []
    if classes:
        c = F.col(classes).cast("double")
        labels.append(F.when(c.isin(0.0, 1.0), c).alias("__c"))
    of = train.select(vector_to_array(features).alias("__x"), *labels)
    of = of.select(*[F.col("__x")[j].alias(c) for j, c in enumerate(names)], *of.columns[1:])
    cut = [j for j, c in enumerate(cuts) if c]
    if cut:
        # a bin ends with its cut: the next number begins the one above
        of = Bucketizer(splitsArray=[[-inf, *[nextafter(c, inf) for c in cuts[j]], inf] for j in cut],
                        inputCols=[names[j] for j in cut], outputCols=[f"__b{j}" for j in cut]).transform(of)
    bins = [F.col(f"__b{j}").cast("long") if cuts[j] else F.lit(0).cast("long") for j in range(d)]
    keys = [reduce(Column.bitwiseOR, [F.shiftleft(b, BIN_BITS * i) for i, b in enumerate(bins[at:at + KEY_BINS])]).alias(f"__k{at // KEY_BINS}")
            for at in range(0, d, KEY_BINS)]
    ks = [f"__k{i}" for i in range(len(keys))]
    of = of.select(*keys, *[c for c in ("__y", "__c") if c in of.columns])
    if added:
        # a missing label stays missing, so that the fit refuses it
        whole = lambda c, total: F.when(F.count(c) == F.count(F.lit(1)), total).alias(c)
        of = of.groupBy(*ks).agg(F.count(F.lit(1)).cast("double").alias("__n"), *([whole("__y", F.avg("__y"))] if target else []),
                                 *([whole("__c", F.sum("__c"))] if classes else []))
    cores = train.sparkSession.sparkContext.defaultParallelism
    block = max(1, min(TASK_ROWS, -(-n // cores)))

    def pack(held: list[pd.DataFrame]) -> pd.DataFrame:
        pdf = pd.concat(held)
        k = [pdf[c].to_numpy() for c in ks]
        of = np.array([k[j // KEY_BINS] >> BIN_BITS * (j % KEY_BINS) & (1 << BIN_BITS) - 1 for j in range(d)], dtype=np.uint8)
        columns = [pdf[c].to_numpy(dtype=float) if c in pdf else np.zeros(0) for c in ("__n", "__y", "__c")]
        if any(np.isnan(c).any() for c in columns):
            raise ValueError("labels must not be null or NaN, classes must be 0 or 1")
        return pd.DataFrame([[len(pdf), of.tobytes(), *[c.tobytes() for c in columns]]], columns=["n", "bins", "rows", "y", "c"])

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            if size >= block:
                yield pack(held)
                held, size = [], 0
        if size:
            yield pack(held)

    blocks = of.mapInPandas(packed, "n long, bins binary, rows binary, y binary, c binary")
    return Cells(cut_lineage(blocks if added else blocks.repartition(max(cores, -(-n // TASK_ROWS)))), cuts, n, added)


def _loaded(of: Cells, weights: tuple[float, float] | None) -> RDD:
    """(number, bins by feature, weights, targets, scores of 0) of every task's rows;
    for two classes, whose weights are given, the weights of either in place of both."""
    d = len(of.cuts)
    cores = of.blocks.sparkSession.sparkContext.defaultParallelism
    total = of.blocks.agg(F.sum("n")).first()[0]
    rows = of.blocks.rdd.coalesce(max(cores, -(-total // TASK_ROWS)))

    def load(number: int, rows: Iterator) -> Iterator[tuple]:
        rows = [r for r in rows if r[0]]
        if not rows:
            return
        bins = np.concatenate([np.frombuffer(r[1], np.uint8).reshape(d, r[0]) for r in rows], axis=1)
        w = np.concatenate([np.frombuffer(r[2]) if len(r[2]) else np.ones(r[0]) for r in rows])
        y = np.concatenate([np.frombuffer(r[4 if weights else 3]) for r in rows])
        if weights:
            w, y = (w - y) * weights[0], y * weights[1]
        yield number, bins, w, y, np.zeros(len(y))

    return rows.mapPartitionsWithIndex(load)


@dataclass
class Tree:
    """Nodes in the order in which they were made; a leaf has feature -1."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        n = bins.shape[1]
        flat, each, node = bins.ravel(), np.arange(n), np.zeros(n, dtype=np.int64)
        # a leaf leads to itself: no bin is above its cut
        offset, left = np.maximum(self.feature, 0) * n, np.where(self.feature < 0, np.arange(len(self.feature)), self.left)
        cut = np.where(self.feature < 0, MAX_BINS, self.cut)
        for _ in range(self.depth()):
            node = left[node] + (flat[offset[node] + each] > cut[node])
        return node

    def depth(self) -> int:
        deep = np.zeros(len(self.feature), dtype=int)
        for i in np.flatnonzero(self.feature >= 0):  # children come after their node
            deep[self.left[i]:self.left[i] + 2] = deep[i] + 1
        return int(deep.max())


def _aims(w: np.ndarray, y: np.ndarray, score: np.ndarray, first: bool, signed: bool) -> tuple[np.ndarray, ...]:
    """Weights, weights x aims, weights x aims x aims of what a round's tree learns:
    the label (1 and -1 for two classes), then the negative gradient."""
    if signed:
        low, high = (-1.0, 1.0) if first else (-4.0 / (1.0 + np.exp(-2.0 * score)), 4.0 / (1.0 + np.exp(2.0 * score)))
        a, b = w * low, y * high
        return w + y, a + b, a * low + b * high
    aim = y if first else 2.0 * (y - score)
    return w, w * aim, w * aim * aim


def _sums(state: RDD, tree: Tree, nodes: Sequence[int], d: int, last: bool, first: bool, signed: bool, draw: tuple[float, int, int] | None) -> np.ndarray:
    """By node, feature and bin: weights, weights x aims, a node's weights x aims x
    aims in bin 0 of one more feature. The ``last`` level has the nodes' own sums
    alone, in bin 0."""
    m = len(nodes)

    def add(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        out = np.zeros((2, d + 1, m * MAX_BINS))
        place = np.full(len(tree.feature), -1)
        place[list(nodes)] = np.arange(m) * MAX_BINS
        for number, bins, w, y, score in blocks:
            at = place[tree.leaves(bins)]
            use = at >= 0
            if draw:
                use &= np.random.default_rng([draw[1], draw[2], number]).random(len(w)) < draw[0]
            if not use.all():
                bins, w, y, score, at = bins[:, use], w[use], y[use], score[use], at[use]
            w, wa, waa = _aims(w, y, score, first, signed)
            for j in range(1 if last else d):
                cell = at if last else at + bins[j]
                out[0, j] += np.bincount(cell, w, m * MAX_BINS)
                out[1, j] += np.bincount(cell, wa, m * MAX_BINS)
            out[0, d] += np.bincount(at, waa, m * MAX_BINS)
        yield out

    parts = state.mapPartitions(add)
    total = parts.treeReduce(np.add) if parts.getNumPartitions() > MANY_PARTS else reduce(np.add, parts.collect())
    return total.reshape(2, d + 1, m, MAX_BINS)


def _grow(state: RDD, of: Cells, depth: int, per_node: int, rng: np.random.Generator, first: bool, signed: bool, draw) -> tuple[Tree, list[tuple]]:
    """A tree and of each node (weight, mean, impurity, gain, weights x aims, x aims x aims)."""
    d = len(of.cuts)
    splits = np.array([len(c) for c in of.cuts])
    feature, cut, left, told = [-1], [0], [0], [None]
    level = [0]
    for deep in range(depth + 1):
        if not level:
            break
        grown = []
        step = max(1, HELD_SUMS // ((d + 1) * MAX_BINS * 2))
        tree = Tree(np.array(feature), np.array(cut), np.array(left))
        for nodes in (level[i:i + step] for i in range(0, len(level), step)):
            sums = _sums(state, tree, nodes, d, deep == depth, first, signed, draw)
            for i, node in enumerate(nodes):
                w, a = sums[0, :d, i], sums[1, :d, i]
                W, A, Q = w[0].sum(), a[0].sum(), sums[0, d, i, 0]
                if W <= 0:
                    raise ValueError("no training rows were drawn")
                impurity = (Q - A * A / W) / W
                told[node] = (W, A / W, impurity, 0.0, A, Q)
                if deep == depth or impurity < EPSILON:
                    continue
                wl, al = w.cumsum(axis=1)[:, :-1], a.cumsum(axis=1)[:, :-1]
                wr, ar = W - wl, A - al
                # whether there are rows is told by the bins, not by a difference of sums
                some = (w > 0).cumsum(axis=1)[:, :-1]
                valid = (some > 0) & (some < (w > 0).sum(axis=1)[:, None]) & (np.arange(MAX_BINS - 1) < splits[:, None])
                if per_node < d:
                    valid[np.setdiff1d(np.arange(d), rng.choice(d, per_node, replace=False))] = False
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(valid, (al * al / wl + ar * ar / wr - A * A / W) / W, -inf)
                # the first of equal ones, whatever order their sums came in
                j, b = np.unravel_index(int((gain >= gain.max() * (1 - TIE)).argmax()), gain.shape)
                if not gain[j, b] > 0:
                    continue
                told[node] = (W, A / W, impurity, float(gain[j, b]), A, Q)
                feature[node], cut[node], left[node] = int(j), int(b), len(feature)
                grown += [len(feature), len(feature) + 1]
                for _ in range(2):
                    feature.append(-1), cut.append(0), left.append(0), told.append(None)
        level = grown
    return Tree(np.array(feature), np.array(cut), np.array(left)), told


def _java(jvm, gateway, tree: Tree, told: list[tuple], cuts: Sequence[Sequence[float]], node: int = 0):
    """The Spark node of ``node``, with values as thresholds."""
    W, mean, impurity, gain, A, Q = (float(v) for v in told[node])
    stats = gateway.new_array(jvm.double, 3)
    stats[0], stats[1], stats[2] = W, A, Q
    stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, max(1, round(W)))
    nodes = jvm.org.apache.spark.ml.tree
    if tree.feature[node] < 0:
        return nodes.LeafNode(mean, impurity, stats), mean
    j, b, child = int(tree.feature[node]), int(tree.cut[node]), int(tree.left[node])
    (low, a), (high, b_) = (_java(jvm, gateway, tree, told, cuts, c) for c in (child, child + 1))
    if a is not None and a == b_:  # twins say the same
        return nodes.LeafNode(a, impurity, stats), a
    return nodes.InternalNode(mean, impurity, gain, low, high, nodes.ContinuousSplit(j, float(cuts[j][b])), stats), None


def subset(strategy: str, d: int) -> int | None:
    """Features that a node looks at; None for a strategy that isn't a share, a number or all."""
    if strategy == "all":
        return d
    try:
        v = float(strategy)
    except ValueError:
        return None
    return ceil(v * d) if v <= 1.0 else min(int(v), d)


def boost(estimator, of: Cells, weights: tuple[float, float] = (1.0, 1.0)):
    """``estimator`` (GBTRegressor / GBTClassifier) fitted on ``of``; ``weights`` of the classes."""
    get = estimator.getOrDefault
    share, step, seed = get("subsamplingRate"), get("stepSize"), get("seed")
    signed = isinstance(estimator, GBTClassifier)
    if share < 1.0 and of.added:
        raise ValueError("rounds draw single rows: cells(..., added=False)")
    sc, d = of.blocks.sparkSession.sparkContext, len(of.cuts)
    rng = np.random.default_rng(seed)
    state = _loaded(of, weights if signed else None).persist(StorageLevel.MEMORY_AND_DISK)
    before, grown, by = None, [], []
    try:
        for r in range(get("maxIter")):
            tree, told = _grow(state, of, get("maxDepth"), subset(get("featureSubsetStrategy"), d), rng, r == 0, signed,
                               (share, seed, r) if share < 1.0 else None)
            grown.append((tree, told))
            by.append(1.0 if r == 0 else step)
            means = np.array([t[1] for t in told]) * by[-1]

            def scored(block: tuple, tree=tree, means=means) -> tuple:
                number, bins, w, y, score = block
                return number, bins, w, y, score + means[tree.leaves(bins)]
            # the next tree's first level makes the new scores
            if before is not None:
                before.unpersist()
            before, state = state, state.map(scored).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for held in (before, state):
            if held is not None:
                held.unpersist()
    jvm, gateway = sc._jvm, sc._gateway
    ml = jvm.org.apache.spark.ml
    trees, by_ = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(grown)), gateway.new_array(jvm.double, len(grown))
    for i, ((tree, told), w) in enumerate(zip(grown, by)):
        root, _ = _java(jvm, gateway, tree, told, of.cuts)
        trees[i], by_[i] = ml.regression.DecisionTreeRegressionModel(f"dtr_{estimator.uid}_{i}", root, d), w
    uid = f"{estimator.uid}_model"
    if signed:
        model = GBTClassificationModel(ml.classification.GBTClassificationModel(uid, trees, by_, d, 2))
    else:
        model = GBTRegressionModel(ml.regression.GBTRegressionModel(uid, trees, by_, d))
    estimator._copyValues(model)
    model._transfer_params_to_java()
    return model


def class_rows(of: Cells) -> tuple[float, float]:
    """Rows of class 0 and of class 1."""
    ones = of.blocks.rdd.map(lambda r: float(np.frombuffer(r[4]).sum())).sum()
    return of.n - ones, ones

"""Per-row additive contributions for Spark tree ensembles.

Default: Shapley values of the path-dependent game. Features outside a subset
are integrated out by the trees' own covers (training rows per node), so a leaf
counts with the product, over the features on its path, of 1 or 0 (the row
keeps to the path's bounds on a known feature) or of the cover shares (an
unknown one). A leaf's game has no more players than its path has features, and
a row enters it only by which bounds it keeps to: the leaf's Shapley values are
tabulated once for every such pattern, from the polynomial coefficients that
weigh subsets by size, and looked up per row. ``base`` is the expected value.

``method="path"`` credits every split on the row's path with the change of the
node value instead; ``base`` is then the weighted sum of root values. With
either, ``base + sum(contributions) == prediction``.

The fitted trees (bounded by trees x nodes, not by data) are read once from
the model, shipped with the task closure, and applied batch-wise with NumPy
inside ``mapInPandas``, so every row is explained where it lives. Summaries
(mean |contribution| per feature, per key) are grouped aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flatten_tree(root) -> dict[str, np.ndarray]:
    feat, thr, left, right, val, cover = [], [], [], [], [], []

    def visit(node) -> int:
        i = len(val)
        feat.append(-1), thr.append(0.0), left.append(-1), right.append(-1), val.append(float(node.prediction()))
        cover.append(float(node.impurityStats().count()))
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            if split.getClass().getSimpleName() != "ContinuousSplit":
                raise ValueError("splits on categories have no bounds; encode them as columns first")
            feat[i] = int(split.featureIndex())
            thr[i] = float(split.threshold())
            left[i] = visit(node.leftChild())
            right[i] = visit(node.rightChild())
        return i
    visit(root)
    return {"feat": np.array(feat), "thr": np.array(thr), "left": np.array(left), "right": np.array(right),
            "val": np.array(val), "cover": np.array(cover)}


def ensemble_trees(model) -> tuple[list[dict[str, np.ndarray]], np.ndarray]:
    """Trees and weights of a fitted GBT / random-forest regression model; a
    forest's prediction is the mean of its trees."""
    trees = [_flatten_tree(t._java_obj.rootNode()) for t in model.trees]
    weights = np.asarray(model.treeWeights, dtype=float)
    return trees, weights / weights.sum() if "RandomForest" in type(model).__name__ else weights


def contributions_np(X: np.ndarray, trees, weights) -> tuple[np.ndarray, np.ndarray]:
    """(base per row, path credits rows x features) for a feature matrix."""
    n, d = X.shape
    contrib = np.zeros((n, d))
    base = np.zeros(n)
    rows = np.arange(n)
    for t, w in zip(trees, weights):
        node = np.zeros(n, dtype=np.int64)
        base += w * t["val"][0]
        active = t["feat"][node] >= 0
        while active.any():
            f = t["feat"][node]
            go_left = X[rows, np.maximum(f, 0)] <= t["thr"][node]
            child = np.where(go_left, t["left"][node], t["right"][node])
            delta = np.where(active, t["val"][np.maximum(child, 0)] - t["val"][node], 0.0)
            np.add.at(contrib, (rows[active], f[active]), w * delta[active])
            node = np.where(active, child, node)
            active = t["feat"][node] >= 0
    return base, contrib


class LeafGame:
    """One leaf: the features on its path, the bounds (low, high] that the path
    puts on each, and the Shapley values for every pattern of kept bounds."""

    def __init__(self, value: float, bounds: dict[int, tuple[float, float, float]]):
        self.features = np.array(sorted(bounds), dtype=np.int64)
        self.low, self.high, share = (np.array([bounds[f][i] for f in self.features]) for i in range(3))
        m = len(self.features)
        kept = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(np.float64)
        size_weight = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
        self.table = np.zeros((1 << m, m))
        for f in range(m):
            # coefficient k: the subsets of k other features, known ones kept or not, the rest integrated out
            subsets = np.zeros((1 << m, m))
            subsets[:, 0] = 1.0
            for g in range(m):
                if g != f:
                    subsets[:, 1:] = subsets[:, 1:] * share[g] + subsets[:, :-1] * kept[:, g:g + 1]
                    subsets[:, 0] *= share[g]
            self.table[:, f] = value * (kept[:, f] - share[f]) * (subsets @ size_weight)
        self.expected = value * float(np.prod(share))

    def values(self, X: np.ndarray) -> np.ndarray:
        """Rows x features of the path."""
        x = X[:, self.features]
        keeps = ~(x <= self.low) & ((x <= self.high) | np.isinf(self.high))  # a missing value goes right
        return self.table[keeps @ (1 << np.arange(len(self.features)))]


def leaf_games(tree: dict[str, np.ndarray]) -> list[LeafGame]:
    out, todo = [], [(0, {})]
    while todo:
        node, bounds = todo.pop()
        if tree["feat"][node] < 0:
            out.append(LeafGame(float(tree["val"][node]), bounds))
            continue
        f, cut = int(tree["feat"][node]), float(tree["thr"][node])
        low, high, share = bounds.get(f, (-np.inf, np.inf, 1.0))
        for child, new in ((tree["left"][node], (low, min(high, cut))), (tree["right"][node], (max(low, cut), high))):
            todo.append((int(child), bounds | {f: (*new, share * tree["cover"][child] / tree["cover"][node])}))
    return out


def shapley_np(X: np.ndarray, games: Sequence[tuple[float, Sequence[LeafGame]]]) -> tuple[np.ndarray, np.ndarray]:
    """(base per row, Shapley values rows x features) of (tree weight, leaves)."""
    contrib, base = np.zeros(X.shape), 0.0
    for weight, leaves in games:
        for leaf in leaves:
            base += weight * leaf.expected
            contrib[:, leaf.features] += weight * leaf.values(X)
    return np.full(len(X), base), contrib


def tree_contributions(df: DataFrame, model, features_col: str, key: str, names: Sequence[str], method: str = "shapley") -> DataFrame:
    """Wide output per row: key, base, prediction (sum of parts) and one
    ``contrib_{name}`` column per feature."""
    trees, weights = ensemble_trees(model)
    games = [(w, leaf_games(t)) for w, t in zip(weights, trees)] if method == "shapley" else []
    fields = [df.schema[key], T.StructField("base", T.DoubleType()), T.StructField("explained", T.DoubleType()),
              *[T.StructField(f"contrib_{n}", T.DoubleType()) for n in names]]

    def run(it):
        for pdf in it:
            if pdf.empty:
                continue
            X = np.vstack(pdf["__x"].to_numpy())
            base, c = shapley_np(X, games) if games else contributions_np(X, trees, weights)
            out = {key: pdf[key].to_numpy(), "base": base, "explained": base + c.sum(axis=1)}
            for j, n in enumerate(names):
                out[f"contrib_{n}"] = c[:, j]
            yield pd.DataFrame(out)

    x = df.select(key, vector_to_array(features_col).alias("__x"))
    return x.mapInPandas(run, T.StructType(fields))


def mean_abs_contribution(contrib: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """T5: mean |contribution| per feature (per group), long form, one aggregate."""
    row = contrib.groupBy(*by).agg(*[F.avg(F.abs(f"contrib_{n}")).alias(f"m{i}") for i, n in enumerate(names)])
    return row.select(*by, F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(f"m{i}").alias("mean_abs_contribution"))
        for i, n in enumerate(names)])).alias("s")).select(*by, "s.*")

"""Gradient boosting of three or more classes as one model: softmax residuals, one tree a class and round.

Rows are binned once. A level of all trees of a round is grown in one pass: every task adds up, for each class,
open node, feature and bin, the rows with their residuals and curvatures, and Spark sums these cells. The driver sees the
cells, as many as classes x open nodes x features x bins, never rows. A leaf's value is one Newton step from the sums that chose its
split, so leaves need no pass of their own.

A row's scores are kept in a table that is renewed every ``REFRESH`` rounds; in between, a pass applies the few newer trees
itself. So every pass reads a kept table, and a lost executor costs a re-read or one step of lineage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.session import materialize

BINS = 32
REFRESH = 8
#: Precision of the approximate quantiles that bins are cut at, as the inverse of the rank error.
ACCURACY = 10_000


@dataclass
class Tree:
    """Nodes in a heap: the children of node i are 2 i + 1 and 2 i + 2. A leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), *(np.zeros(n, kind) for kind in (np.int32, float, float, float, float)))

    def node_of(self, columns: np.ndarray, cuts: np.ndarray, levels: int) -> np.ndarray:
        """The node each row has come to after some levels; ``cuts`` are in the rows' own units."""
        at, rows = np.zeros(len(columns), np.int64), np.arange(len(columns))
        for _ in range(levels):
            feature = self.feature[at]
            right = columns[rows, np.maximum(feature, 0)] > cuts[at]
            at = np.where(feature < 0, at, 2 * at + 1 + right)
        return at


@dataclass
class SoftmaxBoostingModel:
    """Scores of the classes are their starting log shares plus the trees' leaves; probabilities are their softmax."""

    start: np.ndarray
    rounds: list[list[Tree]]
    depth: int
    n_features: int
    losses: list[float]
    features_column: str

    @property
    def featureImportances(self):  # noqa: N802  as the models of MLlib call it
        gains = np.zeros(self.n_features)
        for trees in self.rounds:
            for tree in trees:
                split = tree.feature >= 0
                own = np.bincount(tree.feature[split], tree.gain[split], self.n_features)
                gains += own / own.sum() if own.sum() > 0 else 0
        return Vectors.dense(gains / gains.sum() if gains.sum() > 0 else gains)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.start, (len(x), 1))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += tree.value[tree.node_of(x, tree.threshold, self.depth)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` and ``prediction`` (the first of equal classes)."""
        def chances(vectors: pa.Array) -> pa.Array:
            return _lists(softmax(self.scores(_matrix(vectors, self.n_features))))

        scored = df.withColumn("_chances", F.arrow_udf(chances, "array<double>")(vector_to_array(self.features_column)))
        best = F.array_position("_chances", F.array_max("_chances")) - 1
        return scored.withColumn("probability", array_to_vector("_chances")).withColumn("prediction", best.cast("double")).drop("_chances")


@dataclass(frozen=True)
class SoftmaxBoosting:
    """The estimator; ``fit`` takes rows with a feature vector and a class position from 0."""

    featuresCol: str  # noqa: N815
    labelCol: str  # noqa: N815
    classes: int
    rounds: int = 100
    depth: int = 5
    rate: float = 0.1
    min_leaf: int = 2
    min_split: int = 5
    bins: int = BINS

    def fit(self, rows: DataFrame) -> SoftmaxBoostingModel:
        known = rows.where(F.col(self.labelCol).isNotNull()).select(
            vector_to_array(self.featuresCol).alias("x"), F.col(self.labelCol).cast("int").alias("label"))
        width = known.select(F.size("x")).first()
        if width is None:
            raise ValueError("boosting needs rows with a class")
        cuts = feature_cuts(known, width[0], self.bins)
        shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        total = sum(shares.values())
        start = np.log([max(shares.get(k, 0), 1e-9) / total for k in range(self.classes)])

        def binned(vectors: pa.Array) -> pa.Array:
            x = _matrix(vectors, len(cuts))
            return _lists(np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1).astype(np.int32))

        first = F.array(*[F.lit(float(s)) for s in start])
        state = materialize(known.select(F.arrow_udf(binned, "array<int>")("x").alias("bins"), "label", first.alias("scores")))
        trees, recent, losses = [], [], []
        for number in range(self.rounds):
            grown, loss = self._round(state, cuts, recent)
            losses.append(loss / total)
            if all(t.feature[0] < 0 for t in grown):
                break
            trees.append(grown)
            recent.append(grown)
            if len(recent) == REFRESH and number + 1 < self.rounds:
                state, recent = materialize(state.select("bins", "label", self._renewed(recent).alias("scores"))), []
        return SoftmaxBoostingModel(start, trees, self.depth, len(cuts), losses, self.featuresCol)

    def _renewed(self, recent: list[list[Tree]]) -> Column:
        depth = self.depth

        def added(bins: pa.Array, scores: pa.Array) -> pa.Array:
            return _lists(_with_trees(_matrix(bins, -1), _matrix(scores, -1), recent, depth))

        return F.arrow_udf(added, "array<double>")("bins", "scores")

    def _round(self, state: DataFrame, cuts: list[np.ndarray], recent: list[list[Tree]]) -> tuple[list[Tree], float]:
        """One tree a class, and the loss before this round."""
        trees = [Tree.empty(self.depth) for _ in range(self.classes)]
        open_nodes, loss = [(k, 0) for k in range(self.classes)], 0.0
        for level in range(self.depth):
            cells, lost = self._cells(state, trees, recent, open_nodes, level, len(cuts))
            loss = loss or lost
            open_nodes = [child for place, node in enumerate(open_nodes) for child in self._split(trees, node, cells[place], cuts, level)]
            if not open_nodes:
                break
        return trees, loss

    def _cells(self, state: DataFrame, trees: list[Tree], recent: list[list[Tree]], open_nodes: list[tuple[int, int]], level: int, n_features: int):
        """Rows, residuals and curvatures summed per open node, feature and bin; and the loss."""
        classes, bins, depth = self.classes, self.bins, self.depth
        place = np.full((classes, 2 ** (depth + 1) - 1), -1)
        for i, (k, node) in enumerate(open_nodes):
            place[k, node] = i
        size = len(open_nodes) * n_features * bins

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, lost = np.zeros((3, size)), 0.0
            offsets = np.arange(n_features) * bins
            for batch in batches:
                if not batch.num_rows:
                    continue
                columns = _matrix(batch.column(0), n_features)
                label = batch.column(1).to_numpy()
                chances = softmax(_with_trees(columns, _matrix(batch.column(2), classes), recent, depth))
                lost -= float(np.log(np.maximum(chances[np.arange(len(label)), label], 1e-300)).sum())
                cell_of_row = columns + offsets
                for k in range(classes):
                    at = place[k, trees[k].node_of(columns, trees[k].cut, level)]
                    own = at >= 0
                    residual = (label == k) - chances[:, k]
                    cells = (at[own, None] * n_features * bins + cell_of_row[own]).ravel()
                    for s, measure in enumerate((np.ones(len(label)), residual, np.abs(residual) * (1 - np.abs(residual)))):
                        sums[s] += np.bincount(cells, np.repeat(measure[own], n_features), size)
            cells = np.flatnonzero(sums[0])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(cells, -1)), *[pa.array(np.append(s[cells], lost)) for s in sums]], ["cell", "n", "r", "h"])

        partial = state.mapInArrow(run, "cell bigint, n double, r double, h double")
        summed = partial.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "r", "h")]).toArrow()
        cell, *measures = (summed.column(c).to_numpy() for c in ("cell", "n", "r", "h"))
        found, whole = np.zeros((size, 3)), cell >= 0
        found[cell[whole]] = np.stack([m[whole] for m in measures], axis=1)
        return found.reshape(len(open_nodes), n_features, bins, 3), float(measures[0][~whole].sum())

    def _split(self, trees: list[Tree], node: tuple[int, int], cells: np.ndarray, cuts: list[np.ndarray], level: int) -> list[tuple[int, int]]:
        """Split a node where the residuals' squares fall most; its children are leaves until they are split."""
        k, at = node
        tree, left = trees[k], cells.cumsum(axis=1)
        whole = left[0, -1]
        if level == 0:
            tree.cover[at], tree.value[at] = whole[0], self._step(whole)
        right = whole - left
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0] - whole[1] ** 2 / whole[0]
        allowed = (left[..., 0] >= self.min_leaf) & (right[..., 0] >= self.min_leaf)
        gain = np.where(allowed, gain, -np.inf)
        feature, cut = np.unravel_index(np.argmax(gain), gain.shape)
        if whole[0] < self.min_split or not gain[feature, cut] > 1e-12 * max(1.0, whole[0]):
            return []
        tree.feature[at], tree.cut[at], tree.threshold[at], tree.gain[at] = feature, cut, cuts[feature][cut], gain[feature, cut]
        for child, sums in ((2 * at + 1, left[feature, cut]), (2 * at + 2, right[feature, cut])):
            tree.cover[child], tree.value[child] = sums[0], self._step(sums)
        return [(k, 2 * at + 1), (k, 2 * at + 2)]

    def _step(self, sums: np.ndarray) -> float:
        """The Newton step of a leaf from its residuals and curvatures, shortened by the rate."""
        return 0.0 if sums[2] < 1e-12 else float(self.rate * (self.classes - 1) / self.classes * sums[1] / sums[2])


def feature_cuts(rows: DataFrame, n_features: int, bins: int) -> list[np.ndarray]:
    """At most ``bins`` - 1 cuts a feature, halfway between neighbouring approximate quantiles; one pass for all."""
    shares = [i / (bins - 1) for i in range(bins)]
    found = rows.agg(*[F.percentile_approx(F.get("x", F.lit(j)), shares, ACCURACY).alias(f"q{j}") for j in range(n_features)]).first()
    values = [np.unique(np.array(q if q is not None else [], float)) for q in found]
    return [(v[1:] + v[:-1]) / 2 for v in values]


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _with_trees(bins: np.ndarray, scores: np.ndarray, rounds: list[list[Tree]], depth: int) -> np.ndarray:
    scores = scores.copy()
    for trees in rounds:
        for k, tree in enumerate(trees):
            scores[:, k] += tree.value[tree.node_of(bins, tree.cut, depth)]
    return scores


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width if width > 0 or not len(lists) else -1)


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))

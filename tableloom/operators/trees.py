"""Tree models as tables: the paths from roots to leaves, and exact Shapley values from them.

A path is what its leaf asks of each feature it meets, an interval, with the share of the training rows that
kept to the path at the feature's splits (one share for all splits of one feature). An output of a tree is
the value of the one leaf whose intervals all hold, so every attribution is a sum over paths, and
paths are spread over the tasks. A task adds up what its paths give to every sampled row before anything is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import classification
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.operators.boosting import SoftmaxBoostingModel
from tableloom.session import kept, local_table, scratch_path, spread

#: Paths whose intervals are held against all sampled rows at once.
PATHS_AT_ONCE = 256

PATHS = {
    "value": pa.float64(), "features": pa.list_(pa.int32()), "low": pa.list_(pa.float64()), "high": pa.list_(pa.float64()),
    "share": pa.list_(pa.float64()),
}


def is_tree_model(model) -> bool:
    return hasattr(model, "treeWeights") or isinstance(model, SoftmaxBoostingModel)


def sums_leaves(model) -> bool:
    """Is the model's output itself the sum of its trees' leaves, and not a function of it?"""
    return not isinstance(model, (SoftmaxBoostingModel, classification.GBTClassificationModel))


def saved_nodes(spark: SparkSession, model) -> DataFrame:
    """The nodes of all trees as Spark saves them, below the shared folder."""
    path = scratch_path(spark, "trees")
    kept(spark).append(path)
    model.write().save(path)
    node = "nodeData."
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col(f"{node}id").alias("id"), F.col(f"{node}prediction").alias("prediction"),
        F.col(f"{node}impurityStats").alias("stats"), F.col(f"{node}leftChild").alias("left"), F.col(f"{node}rightChild").alias("right"),
        F.col(f"{node}split.featureIndex").alias("feature"), F.get(f"{node}split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    )


def tree_paths(spark: SparkSession, model, position: int = 0) -> DataFrame:
    """The paths of an MLlib forest or boosting model; the values of all paths that hold for a row sum to its output.

    The output is the prediction, the probability of the class at ``position`` for a forest of classes, the log-odds of two
    boosted classes, and the score of the class at ``position`` for three or more. The paths are as many as
    the model's leaves, which the driver holds anyway.
    """
    if isinstance(model, SoftmaxBoostingModel):
        return path_table(spark, _softmax_rows(model, position))
    forest = isinstance(model, classification.RandomForestClassificationModel)
    boosted = isinstance(model, classification.GBTClassificationModel)
    count = model.getNumTrees if hasattr(model, "getNumTrees") else len(model.treeWeights)
    averaged = not boosted and "RandomForest" in type(model).__name__
    trees: dict[int, dict[int, dict]] = {}
    for r in saved_nodes(spark, model).collect():
        trees.setdefault(r["tree"], {})[r["id"]] = r
    rows: list[tuple] = []
    for tree, nodes in trees.items():
        weight = 1 / count if averaged else model.treeWeights[tree]
        if boosted:
            weight *= 2 if position == 1 else -2
        cover = {i: sum(n["stats"]) if forest else n["stats"][0] for i, n in nodes.items()}
        values = {i: n["stats"][position] / sum(n["stats"]) if forest else n["prediction"] for i, n in nodes.items() if n["left"] < 0}
        rows += [(weight * values[i], *held) for i, held in _walk(nodes, cover)]
    return path_table(spark, rows)


def _softmax_rows(model: SoftmaxBoostingModel, position: int) -> list[tuple]:
    rows: list[tuple] = [(float(model.start[position]), [], [], [], [])]
    for trees in model.rounds:
        tree = trees[position]
        nodes = {
            i: {"left": 2 * i + 1 if f >= 0 else -1, "right": 2 * i + 2, "feature": int(f), "threshold": float(t)}
            for i, (f, t) in enumerate(zip(tree.feature, tree.threshold))
        }
        rows += [(float(tree.value[i]), *held) for i, held in _walk(nodes, tree.cover)]
    return rows


def path_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Rows of value, features, lower ends (not held), upper ends (held) and shares as a table."""
    columns = list(zip(*rows)) if rows else [[]] * len(PATHS)
    return local_table(spark, **{n: pa.array(list(c), kind) for (n, kind), c in zip(PATHS.items(), columns)})


def _walk(nodes: dict[int, dict], cover: dict[int, float]) -> Iterator[tuple]:
    """Per leaf: its node and, feature by feature, interval and share."""
    waiting: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
    while waiting:
        at, held = waiting.pop()
        node = nodes[at]
        if node["left"] < 0:
            features = sorted(held)
            yield at, (features, *([held[f][i] for f in features] for i in range(3)))
            continue
        feature, threshold = node["feature"], node["threshold"]
        low, high, share = held.get(feature, (-math.inf, math.inf, 1.0))
        for child, interval in ((node["left"], (low, min(high, threshold))), (node["right"], (max(low, threshold), high))):
            waiting.append((child, {**held, feature: (*interval, share * cover[child] / cover[at])}))


def expected_output(paths: DataFrame) -> DataFrame:
    """The mean output when every split sends rows on by its shares: one row, ``base_value``."""
    reach = F.aggregate("share", F.lit(1.0), lambda a, b: a * b)
    return paths.agg(F.sum(F.col("value") * reach).alias("base_value"))


def path_outputs(paths: DataFrame, rows: np.ndarray) -> DataFrame:
    """``i`` and the ``output`` of each of the given rows of features."""
    return _over_paths(paths, rows, lambda value, features, low, high, share, x: _inside(x, features, low, high).all(axis=2) @ value, "i int, output double")


def tree_attributions(paths: DataFrame, rows: np.ndarray, background: np.ndarray | None = None) -> DataFrame:
    """``i``, ``j`` and ``shapley_value``: the exact attribution of row i's output to feature j.

    Without a background, features outside a subset follow a tree's splits by their shares of the
    training rows. With one, they take the values of every background row.
    """
    n = rows.shape[1]

    def by_shares(value, features, low, high, share, x):
        holds = _inside(x, features, low, high)
        return _scatter(value[:, None] * (holds - share) * _subset_weights(holds, share), features, n)

    def by_background(value, features, low, high, share, x):
        holds, width = _inside(x, features, low, high), features.shape[1]
        gain, loss = _unanimity(width)
        total = np.zeros(holds.shape)
        for other in _inside(background, features, low, high):
            own, others = holds & ~other, ~holds & other
            a, b = own.sum(axis=2), others.sum(axis=2)
            possible = (holds | other).all(axis=2)[..., None]
            total += possible * (own * gain[a, b][..., None] - others * loss[a, b][..., None])
        return _scatter(value[:, None] * total / len(background), features, n)

    return _over_paths(paths, rows, by_shares if background is None else by_background, "i int, j int, shapley_value double")


def _inside(x: np.ndarray, features: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Rows by paths by path features: does the row keep to the path there?"""
    own = x[:, features]
    return (own > low) & (own <= high)


def _subset_weights(holds: np.ndarray, share: np.ndarray) -> np.ndarray:
    """For each feature of a path, the weighted mean over all subsets of the others of what they let through.

    A subset of s of m - 1 others weighs s! (m - 1 - s)! / m!, which is the integral of u^s (1 - u)^(m - 1 - s)
    over [0, 1]. Summed over subsets the integrand is a product of one factor a feature, a polynomial of degree m - 1
    in u, which Gauss-Legendre points integrate exactly.
    """
    points, weights = np.polynomial.legendre.leggauss((holds.shape[2] + 1) // 2)
    total = np.zeros(holds.shape)
    for point, weight in zip((points + 1) / 2, weights / 2):
        factor = share * (1 - point) + holds * point
        total += weight * np.prod(factor, axis=2, keepdims=True) / factor
    return total


def _unanimity(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of a feature among a that must join and b that must stay out, for either kind."""
    gain, loss = np.zeros((width + 1, width + 1)), np.zeros((width + 1, width + 1))
    for a in range(width + 1):
        for b in range(width + 1 - a):
            whole = math.factorial(a + b)
            gain[a, b] = math.factorial(a - 1) * math.factorial(b) / whole if a else 0.0
            loss[a, b] = math.factorial(a) * math.factorial(b - 1) / whole if b else 0.0
    return gain, loss


def _scatter(parts: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
    """Sum rows by paths by path features into rows by features."""
    rows = np.arange(len(parts))[:, None, None] * n
    return np.bincount((rows + features[None]).ravel(), parts.ravel(), len(parts) * n).reshape(len(parts), n)


def _over_paths(paths: DataFrame, rows: np.ndarray, part, schema: str) -> DataFrame:
    """Sum ``part`` over all paths, by task first; paths of one number of features are taken together."""
    columns = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            value = batch.column("value").to_numpy()
            widths = batch.column("features").value_lengths().to_numpy()
            starts = np.concatenate([[0], np.cumsum(widths)])[:-1]
            lists = [batch.column(c).flatten().to_numpy() for c in ("features", "low", "high", "share")]
            for width in np.unique(widths):
                same = np.flatnonzero(widths == width)
                for at in range(0, len(same), PATHS_AT_ONCE):
                    chosen = same[at:at + PATHS_AT_ONCE]
                    if not width and len(columns) == 3:
                        continue
                    places = starts[chosen][:, None] + np.arange(width)
                    new = part(value[chosen], *[v[places] for v in lists], rows)
                    total = new if total is None else total + new
        if total is not None:
            cells = np.indices(total.shape).reshape(total.ndim, -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*map(pa.array, cells), pa.array(total.ravel())], columns)

    partial = spread(paths).mapInArrow(run, schema)
    return partial.groupBy(*columns[:-1]).agg(F.sum(columns[-1]).alias(columns[-1]))

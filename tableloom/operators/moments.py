"""Sums of products of columns as matrices: one pass over the rows, added up by Spark.

A task multiplies its batches as matrices and keeps one array of sums for each group. The arrays go on in
blocks of BLOCK numbers, so that they are added by as many tasks as there are blocks; only the sums
reach the driver, whose size is set by the columns and groups and not by the rows.

Values are taken around a value of each column, so that sums of squares lose no digits to a far mean and a column
that does not vary has sums of exactly zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 2_048
CENTER_ROWS = 1_000
#: A spread below this share of the mean square is that of a column that does not vary.
NO_SPREAD = 1e-12
SWEEPS = 10_000


def summed_arrays(rows: DataFrame, accumulate: Callable[[Iterator[pa.RecordBatch]], dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """Flat arrays per group, summed over all tasks."""
    names, schema = ["grp", "block", "cells"], "grp bigint, block int, cells binary"

    def batch_of(found: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([g for g, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int32()),
            pa.array([a.tobytes() for a in found.values()], pa.binary()),
        ], names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, array in accumulate(batches).items():
            flat = array.astype(float).ravel()
            yield batch_of({(group, at // BLOCK): flat[at:at + BLOCK] for at in range(0, len(flat), BLOCK)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for group, block, cells in zip(*(c.to_pylist() for c in batch.columns)):
                held[group, block] = held.get((group, block), 0.0) + np.frombuffer(cells)
        if held:
            yield batch_of(held)

    summed = rows.mapInArrow(partial, schema).repartition("grp", "block").mapInArrow(add, schema)
    out: dict[int, list[np.ndarray]] = {}
    for r in sorted(summed.collect(), key=lambda r: (r["grp"], r["block"])):
        out.setdefault(r["grp"], []).append(np.frombuffer(r["cells"]))
    return {group: np.concatenate(parts) for group, parts in out.items()}


def centers(rows: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """A middle value of each column among some rows; 0 where these have none."""
    some = rows.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).limit(CENTER_ROWS)
    found = some.agg(*[F.percentile_approx(f"c{i}", 0.5).alias(f"c{i}") for i in range(len(columns))]).first()
    return np.array([0.0 if v is None or not np.isfinite(v) else v for v in found])


def correlation_matrix(df: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """Pearson correlations, rows with either missing left out pair by pair; NaN where a column does not vary."""
    rows = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    n, middle = len(columns), centers(rows, [F.col(f"c{i}") for i in range(len(columns))])

    def accumulate(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        both, sums, squares, products = (np.zeros((n, n)) for _ in range(4))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1) - middle
            held = ~np.stack([c.is_null().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            if held.all():
                both += len(x)
                sums += x.sum(axis=0)[:, None]
                squares += (x * x).sum(axis=0)[:, None]
            else:
                x = np.where(held, x, 0.0)
                mask = held.astype(float)
                both += mask.T @ mask
                sums += x.T @ mask
                squares += (x * x).T @ mask
            products += x.T @ x
        return {0: np.stack([both, sums, squares, products])}

    found = summed_arrays(rows, accumulate).get(0)
    if found is None:
        return np.full((n, n), np.nan)
    both, sums, squares, products = found.reshape(4, n, n)
    # Entry (i, j) of sums and squares is of column i over the rows that hold j too.
    spread = both * squares - sums**2
    spread = np.where(spread > NO_SPREAD * both * squares, spread, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        r = (both * products - sums * sums.T) / np.sqrt(spread * spread.T)
    r[~np.isfinite(r)] = np.nan
    return np.clip(r, -1.0, 1.0)


@dataclass(frozen=True)
class FoldSums:
    """Per fold, the sums of products of (1, features, label), taken around ``middle``; training sums are all less a fold's."""

    folds: dict[int, np.ndarray]
    middle: np.ndarray

    def training(self, fold: int) -> np.ndarray:
        return sum((s for f, s in self.folds.items() if f != fold), np.zeros_like(next(iter(self.folds.values()))))

    def r2(self, fold: int, weights: np.ndarray, intercept: float) -> float | None:
        """The explained share on a fold, whose squared errors are a quadratic form of its sums."""
        own = self.folds.get(fold)
        if own is None:
            return None
        form = np.concatenate([[-intercept], -weights, [1.0]])
        error, n = max(0.0, float(form @ own @ form)), own[0, 0]
        spread = own[-1, -1] - own[0, -1] ** 2 / n
        if spread <= NO_SPREAD * own[-1, -1]:
            return 1.0 if error <= NO_SPREAD * n else 0.0
        return 1.0 - error / spread


def fold_sums(rows: DataFrame, features: Column, n_features: int, label: Column, fold: Column) -> FoldSums:
    """The sums of every fold in one pass over the rows."""
    narrow = rows.select(features.alias("x"), label.cast("double").alias("y"), fold.cast("bigint").alias("fold"))
    middle = centers(narrow, [*[F.get("x", F.lit(j)) for j in range(n_features)], F.col("y")])

    def accumulate(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), n_features)
            y, folds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
            whole = np.column_stack([np.ones(len(y)), np.column_stack([x, y]) - middle])
            for f in np.unique(folds):
                part = whole[folds == f]
                found[int(f)] = found.get(int(f), 0.0) + part.T @ part
        return found

    size = n_features + 2
    return FoldSums({f: s.reshape(size, size) for f, s in summed_arrays(narrow, accumulate).items()}, middle)


def solve_linear(sums: np.ndarray, penalty: float, absolute: bool) -> tuple[np.ndarray, float]:
    """Weights and intercept, around the middle, that minimise the penalised squares over the rows of the sums.

    Squares are penalised with ``penalty`` against the sum of squared errors; absolute values against half their mean.
    """
    n, means = sums[0, 0], sums[0, 1:] / sums[0, 0]
    centered = sums[1:, 1:] - n * np.outer(means, means)
    gram, side = centered[:-1, :-1], centered[:-1, -1]
    if absolute:
        weights = _lasso(gram / n, side / n, penalty)
    else:
        weights = np.linalg.solve(gram + penalty * np.eye(len(gram)), side)
    return weights, float(means[-1] - weights @ means[:-1])


def _lasso(gram: np.ndarray, side: np.ndarray, penalty: float) -> np.ndarray:
    """Coordinate descent, one weight after another, until none moves."""
    weights = np.zeros(len(side))
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(side)):
            if gram[j, j] <= 0:
                continue
            rest = side[j] - gram[j] @ weights + gram[j, j] * weights[j]
            new = np.sign(rest) * max(abs(rest) - penalty, 0.0) / gram[j, j]
            moved = max(moved, abs(new - weights[j]) * np.sqrt(gram[j, j]))
            weights[j] = new
        if moved < 1e-12 * max(1.0, float(np.abs(side).max(initial=0.0))):
            break
    return weights

"""Subtree sums of a forest by centroid decomposition of its parent edges.

A component is a connected part of the forest below one top node. Its nodes know the weight that lies in their subtree
within the component. Those with more than half of the component's weight are a path down from the top, since two
subtrees side by side cannot both hold more than half; the deepest is the centroid. Taking it out splits the
component into one part for each child, with that child as top, and the rest above; each has at most half of the weight. All values in the
centroid's subtree, within the component, are summed and added to the nodes of the path, from the centroid
up to the top; the path's subtrees then lose the centroid's weight. A node and one of its descendants are
separated exactly once, by a centroid on the way between them, so when nothing is left every node has the sum of its
subtree.

All large components are split side by side, by grouped sums and joins on their tops, so the rounds
are at most the logarithm of the weight, however deep or wide the forest is. Components of at most ``block`` weight
(and so of at most as many nodes) are finished by the same recursion inside one task each. The centroids of a round
are fewer than the weight divided by ``block``; every table that is joined has been written, so adaptive execution broadcasts
it only at a checked size and otherwise splits a component that holds most rows.

A node is known by ``owner`` and ``depth``: ``paths`` names, for each owner and depth up to its deepest node, the ``ancestor``
at that depth by its owner, and the ``above`` of that one.

Defined cases: an empty forest has no sums; every node has weight 1 or more in its own right, which ends the recursion;
a null value counts as 0; a node without a parent in the table is a top.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import written

BLOCK = 256
NODE = ["owner", "depth"]
TOP = ["top_owner", "top_depth"]


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str], block: int = BLOCK) -> DataFrame:
    """``owner``, ``depth`` and the subtree sums of the values, under their names.

    ``nodes`` has ``owner``, ``depth``, ``parent`` (its owner; null at a top), ``size`` (weight of the subtree)
    and the values as bigint. ``top_owner``, ``top_depth`` and ``weight`` name the component that holds the node.
    """
    sums = [F.lit(0).cast("bigint").alias(f"sum_{v}") for v in values]
    state = written(nodes.select(*NODE, "parent", *TOP, "weight", "size", *[F.coalesce(v, F.lit(0)).alias(v) for v in values], *sums), "forest")
    ended, small = [], [state.where(F.col("weight") <= block)]
    while not (large := state.where(F.col("weight") > block)).isEmpty():
        state = _split(large, paths, values)
        ended.append(state.where(F.col("weight") == 0).select(*NODE, *[f"sum_{v}" for v in values]))
        small.append(state.where(F.col("weight").between(1, block)))
    rest = reduce(DataFrame.unionByName, small).repartition(*TOP).sortWithinPartitions(*TOP, *NODE)
    schema = "owner bigint, depth bigint, " + ", ".join(f"sum_{v} bigint" for v in values)
    finished = rest.select(*NODE, "parent", *TOP, "size", *values, *[f"sum_{v}" for v in values]).mapInArrow(_finish(len(values)), schema)
    found = reduce(DataFrame.unionByName, [finished, *ended])
    return found.select(*NODE, *[F.col(f"sum_{v}").alias(v) for v in values])


def _split(large: DataFrame, paths: DataFrame, values: list[str]) -> DataFrame:
    """Take the centroid out of every component; its own row is left with weight 0."""
    on_path = 2 * F.col("size") > F.col("weight")
    deepest = F.max(F.struct("depth", "owner", "size"))
    centroids = written(large.where(on_path).groupBy(*[F.col(c).alias(f"_{c}") for c in TOP]).agg(deepest.alias("c")).select(
        "_top_owner", "_top_depth", F.col("c.depth").alias("c_depth"), F.col("c.owner").alias("c_owner"), F.col("c.size").alias("c_size"),
    ), "centroids")
    same = (F.col("top_owner") == F.col("_top_owner")) & (F.col("top_depth") == F.col("_top_depth"))
    met = large.join(centroids, same).drop("_top_owner", "_top_depth")
    # Below the centroid lies what has it as its ancestor at that depth; the ancestor one deeper is the part's top.
    steps = paths.select(F.col("owner").alias("_owner"), F.col("depth").alias("_depth"), "ancestor", "above")
    asked = F.when(F.col("depth") > F.col("c_depth"), F.col("c_depth") + 1)
    below = F.coalesce(F.col("above") == F.col("c_owner"), F.lit(False))
    centroid = (F.col("owner") == F.col("c_owner")) & (F.col("depth") == F.col("c_depth"))
    labelled = written(
        met.join(steps, (F.col("owner") == F.col("_owner")) & (asked == F.col("_depth")), "left")
        .withColumn("below", below).withColumn("centroid", centroid).drop("_owner", "_depth", "above"), "labelled")
    totals = written(
        labelled.where("below OR centroid").groupBy(*[F.col(c).alias(f"_{c}") for c in TOP])
        .agg(*[F.sum(v).alias(f"total_{v}") for v in values]), "totals")
    tops = written(labelled.where("below AND depth = c_depth + 1").select(
        F.col("owner").alias("_part"), F.col("depth").alias("_part_depth"), F.col("size").alias("part_weight")), "tops")
    part = F.when(F.col("below"), F.col("ancestor"))
    weight = F.when(F.col("centroid"), F.lit(0)).when(F.col("below"), F.col("part_weight")).otherwise(F.col("weight") - F.col("c_size"))
    return written(
        labelled.join(totals, same).join(
            tops, (part == F.col("_part")) & (F.col("c_depth") + 1 == F.col("_part_depth")), "left")
        .select(
            *NODE, "parent",
            F.when(F.col("below"), F.col("ancestor")).otherwise(F.col("top_owner")).alias("top_owner"),
            F.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            weight.alias("weight"),
            F.when(on_path & ~F.col("centroid"), F.col("size") - F.col("c_size")).otherwise(F.col("size")).alias("size"),
            *values,
            *[F.when(on_path, F.col(f"sum_{v}") + F.col(f"total_{v}")).otherwise(F.col(f"sum_{v}")).alias(f"sum_{v}") for v in values],
        ), "split")


def decompose(parent: list[int], size: list[int], values: list[list[int]], sums: list[list[int]]) -> None:
    """Add the subtree sums of one component, its nodes ordered by depth, to ``sums``.

    ``parent`` has positions (-1 at the top); ``size`` is used up.
    """
    parts = [list(range(len(parent)))]
    while parts:
        nodes = parts.pop()
        weight = size[nodes[0]]
        path = [v for v in nodes if 2 * size[v] > weight]
        centroid = path[-1]
        under, label, above = {}, {}, []
        for v in nodes:
            if parent[v] == centroid:
                label[v], under[v] = v, [v]
            elif parent[v] in label:
                label[v] = label[parent[v]]
                under[label[v]].append(v)
            elif v != centroid:
                above.append(v)
        for value, out in zip(values, sums):
            total = value[centroid] + sum(map(value.__getitem__, label))
            for v in path:
                out[v] += total
        for v in path[:-1]:
            size[v] -= size[centroid]
        parts += [*under.values(), above] if above else under.values()


def _finish(n_values: int):
    """Finish whole components, which come one after another, their nodes by depth."""
    def component(rows: np.ndarray) -> np.ndarray:
        columns = [c.tolist() for c in rows]
        owner, depth, above, _, _, size = columns[:6]
        if len(owner) > 1:
            at = {node: i for i, node in enumerate(zip(owner, depth))}
            parent = [at.get((a, d - 1), -1) for a, d in zip(above, depth)]
            decompose(parent, size, columns[6:6 + n_values], columns[6 + n_values:])
        else:
            columns[6 + n_values:] = [[s[0] + v[0]] for v, s in zip(columns[6:6 + n_values], columns[6 + n_values:])]
        return np.array([owner, depth, *columns[6 + n_values:]], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        names = None
        for batch in batches:
            names = ["owner", "depth", *batch.schema.names[6 + n_values:]]
            rows = np.stack([c.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            rows = rows if held is None else np.concatenate([held, rows], axis=1)
            starts = np.flatnonzero(np.any(rows[3:5, 1:] != rows[3:5, :-1], axis=0)) + 1
            whole, held = np.split(rows, starts, axis=1)[:-1], rows[:, starts[-1]:] if len(starts) else rows
            if whole:
                yield _batch(np.concatenate(list(map(component, whole)), axis=1), names)
        if held is not None and held.shape[1]:
            yield _batch(component(held), names)

    return run


def _batch(columns: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

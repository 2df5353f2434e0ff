"""Exact nearest-neighbour imputation without comparing every row with every donor.

Equal rows are collapsed first, on both sides. Donors are put into cells by value ranges and by which
columns they lack, or, where that would make too many cells (many columns, or many patterns of gaps), with the nearest of
some chosen donors. A cell's box bounds the distance to any of its donors from below, and where they lack
different columns, the bound leaves out as many of the widest gaps as any of them can lack. A row with gaps
first searches its nearest cells, which gives a distance the k-th neighbour cannot exceed, and then
only the cells whose bound is within that distance. Cells are cut into chunks of bounded size, so
one task holds one chunk of donors and one chunk of rows however the data is skewed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.functions.columns import col
from tableloom.operators.levels import BROADCAST_LEVELS, hot_values, lookup_join
from tableloom.session import local_table, materialize

MAX_CELLS = 4_096
MAX_CUTS = 64
CELL_DONORS = 2_000
#: Donors a chosen one stands for, where cells are made around chosen donors.
PIVOT_DONORS = 500
#: Cells of the matrix of bounds that a task holds at once.
BOUND_CELLS = 4_000_000
DONOR_CHUNK = 20_000
ITEM_CHUNK = 5_000

CANDIDATE_SCHEMA = "rid string, c int, distance double, value double, n bigint"


def _vector(columns: Sequence[str]) -> Column:
    """Values in column order; NaN stands for missing inside the Python tasks."""
    return F.array(*[F.coalesce(col(c).cast("double"), F.lit(float("nan"))) for c in columns])


def _row_id(columns: Sequence[str]) -> Column:
    return F.md5(F.concat_ws(",", *[F.coalesce(col(c).cast("double").cast("string"), F.lit("-")) for c in columns]))


def _cell_of(columns: Sequence[str], cuts: dict[str, list[float]]) -> Column:
    parts = []
    for c in columns:
        bounds = F.array(*[F.lit(x) for x in cuts[c]]).cast("array<double>")
        place = F.size(F.filter(bounds, lambda b: b < col(c).cast("double"))).cast("string")
        parts.append(F.when(col(c).isNull(), "-").otherwise(place))
    return F.concat_ws(",", *parts)


@dataclass(frozen=True)
class Cells:
    """Donor cells: names, boxes and how many donor rows hold each column (all cells x columns)."""

    names: list[str]
    low: np.ndarray
    high: np.ndarray
    present: np.ndarray
    rows: np.ndarray
    distinct: list[int]
    #: How many columns at most a donor of the cell lacks.
    lacking: np.ndarray


@dataclass(frozen=True)
class NeighbourFill:
    """Fill missing numbers with the mean of the ``k`` nearest donors that hold the column.

    The squared distance is over the columns both rows hold, scaled up by all / shared columns.
    Equal distances are taken in order of the donors' values. A row that shares no column with any
    donor gets the column mean.
    """

    source: DataFrame
    columns: tuple[str, ...]
    k: int = 5

    @cached_property
    def donors(self) -> DataFrame:
        """Distinct donor rows with their counts."""
        columns = self.columns
        typed = self.source.select(*[col(c).cast("double").alias(c) for c in columns])
        any_value = F.coalesce(*[col(c) for c in columns]).isNotNull()
        return materialize(typed.where(any_value).groupBy(*[col(c) for c in columns]).agg(F.count(F.lit(1)).alias("_n")))

    @cached_property
    def means(self) -> dict[int, float | None]:
        measures = [
            (F.sum(col(c) * F.col("_n")) / F.sum(F.when(col(c).isNotNull(), F.col("_n")))).alias(f"m_{j}")
            for j, c in enumerate(self.columns)
        ]
        row = self.donors.agg(*measures).first()
        return {j: row[f"m_{j}"] for j in range(len(self.columns))}

    @cached_property
    def indexed(self) -> tuple[DataFrame, Cells]:
        """Donors with their cell, and the cells: by ranges and gaps if these are few enough, else around chosen donors."""
        columns, n = self.columns, self.donors.count()
        wanted = min(MAX_CELLS, max(1, n // CELL_DONORS))
        per_column = min(MAX_CUTS, max(1, round(wanted ** (1 / len(columns)))))
        if wanted > 1:
            per_column = max(per_column, 2)
        cuts = self._cuts(per_column)
        named = self.donors.withColumn("_cell", _cell_of(columns, cuts))
        found = self._described(named).limit(MAX_CELLS + 1).collect()
        if len(found) > MAX_CELLS:
            named = materialize(self._around_pivots(min(MAX_CELLS, -(-n // PIVOT_DONORS))))
            found = self._described(named).collect()
        found.sort(key=lambda r: r["_cell"])
        places = range(len(columns))

        def matrix(name: str) -> np.ndarray:
            values = [[r[f"{name}_{j}"] for j in places] for r in found]
            return np.array(values, dtype="float64").reshape(len(found), len(columns))

        cells = Cells(
            [r["_cell"] for r in found], matrix("lo"), matrix("hi"), matrix("n"),
            np.array([r["rows"] for r in found], dtype="float64"), [r["distinct"] for r in found],
            np.array([r["lacking"] for r in found], dtype="int64"),
        )
        return named.select("_cell", _vector(columns).alias("z"), F.col("_n").alias("n")), cells

    def _described(self, named: DataFrame) -> DataFrame:
        """Per cell: its box, and how many donors and values it has."""
        columns = self.columns
        return named.groupBy("_cell").agg(
            F.count(F.lit(1)).alias("distinct"), F.sum("_n").alias("rows"),
            F.max(sum((col(c).isNull().cast("int") for c in columns), F.lit(0))).alias("lacking"),
            *[F.min(col(c)).alias(f"lo_{j}") for j, c in enumerate(columns)],
            *[F.max(col(c)).alias(f"hi_{j}") for j, c in enumerate(columns)],
            *[F.sum(F.when(col(c).isNotNull(), F.col("_n")).otherwise(0)).alias(f"n_{j}") for j, c in enumerate(columns)],
        )

    def _around_pivots(self, pivots: int) -> DataFrame:
        """Every donor with the nearest of some donors, drawn by hash among those with the fewest gaps.

        Only the size of the cells depends on the choice, not the result. The chosen rows are at most MAX_CELLS.
        """
        columns = self.columns
        gaps = sum((col(c).isNull().cast("int") for c in columns), F.lit(0))
        drawn = self.donors.select(_vector(columns).alias("z"), gaps.alias("gaps")).orderBy("gaps", F.xxhash64("z")).limit(pivots)
        chosen = np.array([r["z"] for r in drawn.collect()], dtype="float64").reshape(-1, len(columns))
        held, values = (~np.isnan(chosen)).astype("float64"), np.nan_to_num(chosen)

        def nearest(batches):
            for batch in batches:
                x = np.stack([c.to_numpy(zero_copy_only=False).astype("float64") for c in batch.columns[:len(columns)]], axis=1)
                own, known = (~np.isnan(x)).astype("float64"), np.nan_to_num(x)
                # Mean squared gap over the shared columns, from products of values, squares and masks.
                total = (known**2) @ held.T - 2 * known @ values.T + own @ (values**2).T
                shared = own @ held.T
                with np.errstate(divide="ignore", invalid="ignore"):
                    cell = np.argmin(np.where(shared > 0, total / shared, np.inf), axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(str), pa.string())], [*batch.schema.names, "_cell"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.donors.schema.fields)
        return self.donors.mapInArrow(nearest, f"{schema}, _cell string")

    def _cuts(self, per_column: int) -> dict[str, list[float]]:
        if per_column < 2:
            return {c: [] for c in self.columns}
        shares = [i / per_column for i in range(1, per_column)]
        row = self.donors.agg(*[
            F.percentile_approx(col(c), shares, 1000).alias(f"q_{j}") for j, c in enumerate(self.columns)
        ]).first()
        return {c: sorted(set(row[f"q_{j}"] or [])) for j, c in enumerate(self.columns)}

    def transform(self, df: DataFrame) -> DataFrame:
        columns = self.columns
        gaps = F.lit(False)
        for c in columns:
            gaps = gaps | col(c).isNull()
        typed = df.withColumns({c: col(c).cast("double") for c in columns})
        whole, gapped = typed.where(~gaps), typed.where(gaps).withColumn("_rid", _row_id(columns))
        counts = materialize(gapped.groupBy(F.col("_rid").alias("rid")).agg(
            F.count(F.lit(1)).alias("n"), F.first(_vector(columns)).alias("x")
        ))
        size = counts.agg(F.count(F.lit(1)).alias("ids"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
        if size["ids"] == 0:
            return typed
        fills = self._fills(counts.select("rid", "x"))
        hot = hot_values(counts, "rid", size["rows"]) if size["ids"] > BROADCAST_LEVELS else ()
        spread = F.xxhash64(*[col(c) for c in df.columns])
        joined = lookup_join(gapped, F.col("_rid"), fills, "rid", size["ids"], 32 * size["ids"], hot, spread)
        filled = [
            F.coalesce(col(c), F.col(f"fill_{columns.index(c)}"), F.lit(self.means[columns.index(c)])).alias(c)
            if c in columns else col(c)
            for c in df.columns
        ]
        return whole.unionByName(joined.select(*filled))

    def _rounds(self, receivers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Candidates in running order, and the pairs of item and cell searched first and then."""
        missing = F.filter(F.sequence(F.lit(0), F.lit(len(self.columns) - 1)), lambda j: F.isnan(F.get("x", j)))
        items = receivers.withColumn("c", F.explode(missing))
        first = materialize(self._assigned(items.withColumn("radius", F.lit(None).cast("double"))))
        near = materialize(self._search(first))
        reach = F.min(F.when(F.col("reached") >= self.k, F.col("distance"))).alias("radius")
        radius = self._ranked(near).groupBy("rid", "c").agg(reach)
        # No k donors found yet: every cell is in reach.
        bounded = items.join(radius, ["rid", "c"], "left").withColumn("radius", F.coalesce("radius", F.lit(float("inf"))))
        rest = materialize(self._assigned(bounded))
        return self._ranked(near.unionByName(self._search(rest))), first, rest

    def _fills(self, receivers: DataFrame) -> DataFrame:
        """One row per distinct row with gaps: its id and a fill for each column it lacks."""
        ranked, _, _ = self._rounds(receivers)
        taken = F.least(F.col("n"), F.lit(self.k) - (F.col("reached") - F.col("n")))
        means = (
            ranked.withColumn("taken", taken).where("taken > 0").groupBy("rid", "c")
            .agg((F.sum(F.col("value") * F.col("taken")) / F.sum("taken")).alias("fill"))
        )
        return means.groupBy("rid").agg(*[
            F.max(F.when(F.col("c") == j, F.col("fill"))).alias(f"fill_{j}") for j in range(len(self.columns))
        ])

    def _ranked(self, candidates: DataFrame) -> DataFrame:
        """Running donor count per row and column over its k nearest candidates.

        The row number limit is applied before the shuffle too, so a row that met many chunks does
        not bring all their candidates to one task.
        """
        order = Window.partitionBy("rid", "c").orderBy("distance", "value")
        nearest = candidates.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= self.k)
        running = order.rowsBetween(Window.unboundedPreceding, 0)
        return nearest.drop("_place").withColumn("reached", F.sum("n").over(running))

    def _assigned(self, items: DataFrame) -> DataFrame:
        """Pair each item with the cells to search: without a radius its nearest cells that hold k
        donors, with one the remaining cells whose bound is within it."""
        _, cells = self.indexed
        low, high, present, rows, k = cells.low, cells.high, cells.present, cells.rows, self.k
        names = np.array(cells.names, dtype=object)
        n_columns = len(self.columns)
        partly = (present > 0) & (present < rows[:, None])
        held = present > 0
        # Of the columns that only some donors of a cell hold, one donor lacks at most these.
        lost = np.minimum(cells.lacking - (~held).sum(axis=1), partly.sum(axis=1))
        rows_at_once = max(1, min(128, BOUND_CELLS // (len(names) * n_columns)))

        def bounds(x: np.ndarray) -> np.ndarray:
            total = np.zeros((len(x), len(names)))
            shared = np.zeros_like(total)
            unsure = np.zeros((*total.shape, n_columns)) if lost.any() else None
            for j in range(n_columns):
                gap = np.maximum(np.maximum(low[None, :, j] - x[:, None, j], x[:, None, j] - high[None, :, j]), 0.0)
                both = ~np.isnan(x[:, None, j]) & held[None, :, j]
                square = np.where(both, gap, 0.0) ** 2
                total += square
                shared += both
                if unsure is not None:
                    unsure[:, :, j] = np.where(partly[None, :, j], square, 0.0)
            if unsure is not None:
                # The widest gaps that a donor may not share are left out of the sum; fewer shared columns only scale it up.
                unsure.sort(axis=2)
                widest = np.concatenate([np.zeros((*total.shape, 1)), np.cumsum(unsure[:, :, ::-1], axis=2)], axis=2)
                total = np.maximum(total - np.take_along_axis(widest, lost[None, :, None].repeat(len(x), axis=0), axis=2)[:, :, 0], 0.0)
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(shared > 0, total * (n_columns / shared), np.inf)

        def assign(batches):
            for whole in batches:
                for start in range(0, len(whole), rows_at_once):
                    part = whole.slice(start, rows_at_once)
                    x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, n_columns)
                    c = part.column("c").to_numpy(zero_copy_only=False)
                    radius = part.column("radius").to_numpy(zero_copy_only=False).astype("float64")
                    bound = bounds(x)
                    donors = present[:, c].T
                    bound[donors == 0] = np.inf
                    order = np.argsort(bound, axis=1, kind="stable")
                    sorted_donors = np.take_along_axis(donors, order, axis=1)
                    before = np.cumsum(sorted_donors, axis=1) - sorted_donors
                    near = np.zeros_like(bound, dtype=bool)
                    np.put_along_axis(near, order, before < k, axis=1)
                    reachable = np.isfinite(bound)
                    first = np.isnan(radius)[:, None]
                    with np.errstate(invalid="ignore"):
                        within = bound * (1 - 1e-9) <= radius[:, None]
                    chosen = reachable & np.where(first, near, within & ~near)
                    item, cell = np.nonzero(chosen)
                    picked = part.take(pa.array(item))
                    columns = [pa.array(names[cell], pa.string()), *[picked.column(n) for n in ("rid", "c", "x")]]
                    yield pa.RecordBatch.from_arrays(columns, names=["_cell", "rid", "c", "x"])

        return items.select("rid", "c", "x", "radius").mapInArrow(
            assign, "_cell string, rid string, c int, x array<double>"
        )

    def _search(self, assigned: DataFrame) -> DataFrame:
        """The k nearest donors of each item in each chunk of its cells."""
        donors, cells = self.indexed
        spark = donors.sparkSession
        table = local_table(
            spark, _cell=pa.array(cells.names, pa.string()),
            parts=pa.array([-(-n // DONOR_CHUNK) for n in cells.distinct], pa.int32()),
        )
        loads = assigned.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / ITEM_CHUNK).cast("int").alias("loads"))
        sizes = F.broadcast(table.join(loads, "_cell"))
        last_part, last_load = F.col("parts") - 1, F.col("loads") - 1
        left = (
            assigned.join(sizes, "_cell")
            .withColumn("load", F.pmod(F.xxhash64("rid"), F.col("loads")).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), last_part)))
            .select("_cell", "part", "load", "rid", "c", "x")
        )
        right = (
            donors.join(sizes, "_cell")
            .withColumn("part", F.pmod(F.xxhash64("z"), F.col("parts")).cast("int"))
            .withColumn("load", F.explode(F.sequence(F.lit(0), last_load)))
            .select("_cell", "part", "load", "z", "n")
        )
        k, n_columns = self.k, len(self.columns)

        def matrix(group: pa.Table, name: str) -> np.ndarray:
            return group.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, n_columns)

        def nearest(items: pa.Table, group: pa.Table) -> pa.Table:
            row, distances, values, sizes = [], [], [], []
            if len(items) and len(group):
                z, counts = matrix(group, "z"), group.column("n").to_numpy()
                rows, cs = matrix(items, "x"), items.column("c").to_numpy()
                for start in range(0, len(items), 64):
                    x = rows[start : start + 64]
                    total = np.zeros((len(x), len(z)))
                    shared = np.zeros((len(x), len(z)))
                    for j in range(n_columns):
                        gap = x[:, None, j] - z[None, :, j]
                        both = ~np.isnan(gap)
                        total += np.where(both, gap * gap, 0.0)
                        shared += both
                    with np.errstate(divide="ignore", invalid="ignore"):
                        distance = np.where(shared > 0, total * (n_columns / shared), np.inf)
                    value = z[:, cs[start : start + 64]].T
                    own = np.where(np.isnan(value), np.inf, distance)
                    if own.shape[1] > k:
                        limit = np.partition(own, k - 1, axis=1)[:, k - 1 : k]
                    else:
                        limit = np.full((len(x), 1), np.inf)
                    item, donor = np.nonzero((own <= limit) & np.isfinite(own))
                    order = np.lexsort((value[item, donor], own[item, donor], item))
                    item, donor = item[order], donor[order]
                    # Ties at the limit may be more than k: the first k of each item stay.
                    nearest_k = np.arange(len(item)) - np.searchsorted(item, item) < k
                    item, donor = item[nearest_k], donor[nearest_k]
                    row.append(start + item)
                    distances.append(own[item, donor])
                    values.append(value[item, donor])
                    sizes.append(counts[donor])

            def joined(parts: list, kind) -> pa.Array:
                return pa.array(np.concatenate(parts) if parts else [], kind)

            picked = items.select(["rid", "c"]).take(joined(row, pa.int64()))
            return (
                picked.append_column("distance", joined(distances, pa.float64()))
                .append_column("value", joined(values, pa.float64()))
                .append_column("n", joined(sizes, pa.int64()))
            )

        keys = ["_cell", "part", "load"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(nearest, CANDIDATE_SCHEMA)


def fill_from_neighbours(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    return NeighbourFill(df, tuple(columns), k).transform(df)

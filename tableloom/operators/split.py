"""Reproducible train/test splits and cross-validation folds of exact size.

Rows are ordered by an md5 of their key. Instead of numbering the rows (which would sort a whole
class in one task), the hash at each wanted rank is found by counting hash prefixes. The split itself is
then a comparison with a literal, or with the cut-offs of the row's class, which are joined: few
classes travel as a local table and no row is shuffled; there is no limit to their number.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.functions.columns import col
from tableloom.functions.keys import hash_key, row_keys
from tableloom.operators.levels import LOCAL_BYTES, fits_broadcast, hot_values, lookup_join
from tableloom.session import local_table, materialize

PREFIX_COUNTS = 1_000_000
FETCH_ROWS = 2_000
#: Cut-offs of classes kept on the driver; more stay a table, which is joined by size.
LOCAL_CUTS = 10_000
#: Pairs of class and hash prefix, and rows in one such pair, from which the cut-offs are found on the driver.
FEW_CELLS = 50_000
FEW_DIGITS = 3
#: Rows of one hash prefix that are ranked in one task.
PREFIX_ROWS = 1_000_000
NO_CLASS = "\x00"


def class_text(target: str) -> Column:
    """The class as text; NULL is a class of its own."""
    return F.coalesce(col(target).cast("string"), F.lit(NO_CLASS))


def class_sizes(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(class_text(target).alias("y")).agg(F.count(F.lit(1)).alias("n"))


def smallest_class(df: DataFrame, target: str) -> int | None:
    """Rows of the smallest class, None for an empty table."""
    return class_sizes(df, target).agg(F.min("n")).first()[0]


def hashes_at_ranks(
    df: DataFrame, hashed: Column, ranks: Mapping[str | None, Sequence[int]], group: Column | None = None
) -> dict[str | None, list[str]]:
    """Per group, the hash at each 0-based rank in hash order. Every rank must exist."""
    rows = df.select((F.lit(None).cast("string") if group is None else group).alias("g"), hashed.alias("h"))
    open_ranks = {(g, r): ("", r) for g, wanted in ranks.items() for r in wanted}
    ready: dict[tuple, tuple[str, int]] = {}
    prefixes: dict[tuple, str] = {}
    digits = 3 if len(ranks) * 4096 <= PREFIX_COUNTS else 2
    while open_ranks:
        length = len(next(iter(open_ranks.values()))[0])
        wanted = {(g, prefix) for (g, _), (prefix, _) in open_ranks.items()}
        counted = (
            _with_prefix(rows, wanted, length)
            .groupBy("g", F.substring("h", 1, length + digits).alias("p"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        by_group: dict = {}
        for r in sorted(counted, key=lambda r: r["p"]):
            by_group.setdefault((r["g"], r["p"][:length]), []).append((r["p"], r["n"]))
        still_open = {}
        for target, (prefix, rank) in open_ranks.items():
            for longer, n in by_group[target[0], prefix]:
                if rank < n:
                    whole = n <= FETCH_ROWS or length + digits >= 32
                    (ready if whole else still_open)[target] = (longer, rank)
                    prefixes[target] = longer
                    break
                rank -= n
        open_ranks = still_open
    found: dict[tuple, str] = {}
    for length in sorted({len(p) for p in prefixes.values()}):
        targets = {t: v for t, v in ready.items() if len(v[0]) == length}
        if not targets:
            continue
        # Equal hashes (repeated keys) are fetched once with their count.
        wanted = {(g, p) for (g, _), (p, _) in targets.items()}
        fetched = _with_prefix(rows, wanted, length).groupBy("g", "h").agg(F.count(F.lit(1)).alias("n")).collect()
        lists: dict = {}
        for r in sorted(fetched, key=lambda r: r["h"]):
            lists.setdefault((r["g"], r["h"][:length]), []).append((r["h"], r["n"]))
        for target, (prefix, rank) in targets.items():
            for h, n in lists[target[0], prefix]:
                if rank < n:
                    found[target] = h
                    break
                rank -= n
    return {g: [found[g, r] for r in wanted] for g, wanted in ranks.items()}


def _with_prefix(rows: DataFrame, wanted: set, length: int) -> DataFrame:
    """Rows whose group and hash prefix are among the wanted pairs (at most classes times ranks)."""
    if length == 0:
        return rows
    groups, prefixes = zip(*sorted(wanted, key=str))
    pairs = local_table(rows.sparkSession, _g=pa.array(groups, pa.string()), _p=pa.array(prefixes, pa.string()))
    match = F.col("g").eqNullSafe(F.col("_g")) & (F.substring("h", 1, length) == F.col("_p"))
    return rows.join(F.broadcast(pairs), match, "left_semi")


@dataclass(frozen=True)
class Cuts:
    """Ascending hash cut-offs over all rows."""

    keys: tuple[str, ...]
    seed: int
    values: list[str]

    def attach(self, df: DataFrame, name: str) -> DataFrame:
        """Add how many cut-offs are at or below the row's hash: 0 is the first part, and so on."""
        hashed = hash_key(self.keys, self.seed)
        return df.withColumn(name, sum(((hashed >= c).cast("int") for c in self.values), F.lit(0)))


@dataclass(frozen=True)
class ClassCuts:
    """Ascending hash cut-offs per class, as a table (y, cuts, n)."""

    keys: tuple[str, ...]
    seed: int
    target: str
    table: DataFrame
    n_classes: int
    n_bytes: int
    hot: tuple[str, ...]

    def attach(self, df: DataFrame, name: str) -> DataFrame:
        keyed = df.withColumn("_h", hash_key(self.keys, self.seed))
        cuts = self.table.select("y", F.col("cuts").alias("_cuts"))
        joined = lookup_join(keyed, class_text(self.target), cuts, "y", self.n_classes, self.n_bytes, self.hot, F.xxhash64("_h"))
        part = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_h"))), F.lit(0))
        return joined.withColumn(name, part).drop("_cuts", "_h")


def fit_class_cuts(df: DataFrame, target: str, keys: Sequence[str], ranks: Callable[[Column], Column], seed: int = 42) -> ClassCuts:
    """The hash at each wanted rank of each class; ``ranks`` maps a class's rows to an array of 0-based ranks.

    Rows are counted per class and hash prefix, the prefix that holds a rank is found by a running
    sum over a class's prefixes, and only the rows of these prefixes are ranked. Classes are
    rows throughout: nothing is collected that grows with them, unless they are few.
    """
    rows = df.select(class_text(target).alias("y"), hash_key(keys, seed).alias("h"))
    few = _few_class_cuts(rows, ranks)
    if few is not None:
        return ClassCuts(tuple(keys), seed, target, *few, ())
    total = rows.count()
    digits = 3
    while total / 16**digits > PREFIX_ROWS and digits < 8:
        digits += 1
    prefix = F.substring("h", 1, digits).alias("p")
    counts = materialize(rows.groupBy("y", prefix).agg(F.count(F.lit(1)).alias("n")))
    sizes = counts.groupBy("y").agg(F.sum("n").alias("n"))
    wanted = sizes.select(F.col("y").alias("_y"), F.posexplode(ranks(F.col("n"))).alias("k", "rank"))
    before = Window.partitionBy("y").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    running = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    holds = (F.col("y") == F.col("_y")) & (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    chosen = running.join(wanted, holds).select("_y", F.col("p").alias("_p"), "k", (F.col("rank") - F.col("before")).alias("left"))
    # Equal hashes (repeated keys) are ranked once, with their count.
    inside = rows.join(materialize(chosen), (F.col("y") == F.col("_y")) & (F.substring("h", 1, digits) == F.col("_p")))
    equal = inside.groupBy("y", "k", "left", "h").agg(F.count(F.lit(1)).alias("n"))
    reached = F.sum("n").over(Window.partitionBy("y", "k").orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hits = equal.withColumn("reached", reached).where(F.col("reached") > F.col("left"))
    found = hits.groupBy("y", "k").agg(F.min("h").alias("h"))
    cuts = found.groupBy("y").agg(F.array_sort(F.collect_list("h")).alias("cuts"))
    table = materialize(sizes.join(cuts, "y", "left").select("y", F.coalesce("cuts", F.array().cast("array<string>")).alias("cuts"), "n"))
    seen = table.agg(
        F.count(F.lit(1)).alias("classes"), F.coalesce(F.sum(F.size("cuts")), F.lit(0)).alias("cuts"),
        F.coalesce(F.sum(F.octet_length("y") + 32 * F.size("cuts")), F.lit(0)).alias("bytes"),
    ).first()
    if seen["classes"] + seen["cuts"] <= LOCAL_CUTS and seen["bytes"] <= LOCAL_BYTES:
        local = table.collect()
        table = local_table(
            df.sparkSession, y=pa.array([r["y"] for r in local], pa.string()),
            cuts=pa.array([r["cuts"] for r in local], pa.list_(pa.string())), n=pa.array([r["n"] for r in local], pa.int64()),
        )
    hot = () if fits_broadcast(seen["classes"], seen["bytes"]) else hot_values(table, "y", total)
    return ClassCuts(tuple(keys), seed, target, table, seen["classes"], seen["bytes"], hot)


def _few_class_cuts(rows: DataFrame, ranks: Callable[[Column], Column]) -> tuple[DataFrame, int, int] | None:
    """The cut-offs of few classes in two passes, as a local table with its classes and bytes; None where they are many.

    One pass counts rows by class and hash prefix, the other fetches the hashes under the prefixes that hold a wanted rank.
    """
    spark = rows.sparkSession
    prefix = F.substring("h", 1, FEW_DIGITS).alias("p")
    counted = rows.groupBy("y", prefix).agg(F.count(F.lit(1)).alias("n")).limit(FEW_CELLS + 1).collect()
    if not counted or len(counted) > FEW_CELLS:
        return None
    cells: dict[str, list[tuple[str, int]]] = {}
    for r in sorted(counted, key=lambda r: r["p"]):
        cells.setdefault(r["y"], []).append((r["p"], r["n"]))
    classes = sorted(cells)
    numbers = pa.array([sum(n for _, n in cells[y]) for y in classes], pa.int64())
    sizes = local_table(spark, y=pa.array(classes, pa.string()), n=numbers)
    places: dict[str, list[tuple[str, int]]] = {y: [] for y in classes}
    for r in sizes.select("y", ranks(F.col("n")).alias("ranks")).collect():
        for rank in r["ranks"]:
            for p, n in cells[r["y"]]:
                if rank < n:
                    break
                rank -= n
            if n > FETCH_ROWS:
                return None
            places[r["y"]].append((p, rank))
    wanted = {(y, p) for y, own in places.items() for p, _ in own}
    hashes: dict[tuple[str, str], list[tuple[str, int]]] = {}
    if wanted:
        named = rows.select(F.col("y").alias("g"), "h")
        inside = _with_prefix(named, wanted, FEW_DIGITS).groupBy("g", "h").agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(inside, key=lambda r: r["h"]):
            hashes.setdefault((r["g"], r["h"][:FEW_DIGITS]), []).append((r["h"], r["n"]))
    cuts: list[list[str]] = []
    for y in classes:
        own = []
        for p, rank in places[y]:
            for h, n in hashes[y, p]:
                if rank < n:
                    break
                rank -= n
            own.append(h)
        cuts.append(sorted(own))
    local = local_table(spark, y=pa.array(classes, pa.string()), cuts=pa.array(cuts, pa.list_(pa.string())), n=numbers)
    return local, len(classes), sum(len(y.encode()) + 32 * len(c) for y, c in zip(classes, cuts))


def fit_random_cut(df: DataFrame, keys: Sequence[str], share: float = 0.2, seed: int = 42) -> Cuts:
    """The test part has exactly ceil(share * rows) rows."""
    rows = df.count()
    size = math.ceil(share * rows - 1e-9)
    if size <= 0:
        return Cuts(tuple(keys), seed, [""])
    ranks = [size] if size < rows else []
    return Cuts(tuple(keys), seed, hashes_at_ranks(df, hash_key(keys, seed), {None: ranks})[None])


def fit_stratified_cut(df: DataFrame, target: str, keys: Sequence[str], share: float = 0.2, seed: int = 42) -> ClassCuts:
    """The test part has round(share * class rows) of each class, at least one and never all of it."""
    def ranks(n: Column) -> Column:
        part = F.greatest(F.floor(F.lit(share) * n + 0.5), F.lit(1).cast("bigint"))
        return F.array(F.least(part, n - 1))

    return fit_class_cuts(df, target, keys, ranks, seed)


def split(df: DataFrame, keys: Sequence[str] = (), target: str | None = None, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``. Stratified when a target is given and each of its classes has two rows or more.

    Without keys all columns but the target tell rows apart; equal rows then fall on the same side.
    """
    keys = row_keys(df, keys, [target])
    if target is not None and (smallest_class(df, target) or 0) >= 2:
        cuts = fit_stratified_cut(df, target, keys, share, seed)
    else:
        cuts = fit_random_cut(df, keys, share, seed)
    return cuts.attach(df, "_part").withColumn("is_test", F.col("_part") == 0).drop("_part")


def fold_count(n_rows: int, smallest_class: int | None, requested: int = 5) -> int:
    """Folds the data can carry; ``smallest_class`` is None for regression."""
    folds = min(requested, n_rows // 2)
    if smallest_class is not None:
        if smallest_class == 1:
            return 2
        folds = min(folds, 2 if smallest_class <= 5 else smallest_class)
    return max(2, folds)


def fold_counts_table(df: DataFrame, target: str, task: str, requested: int = 5) -> DataFrame:
    """The same rule as one row: rows, smallest class and folds."""
    counts = df.groupBy(col(target).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.min(F.when(F.col("y").isNotNull(), F.col("n"))).alias("smallest_class")
    )
    smallest = F.col("smallest_class")
    by_size = F.least(F.lit(requested), F.floor(F.col("n_rows") / 2))
    by_class = F.when(smallest == 1, 2).otherwise(F.least(by_size, F.when(smallest <= 5, 2).otherwise(smallest)))
    folds = by_class if task == "classification" else by_size
    return found.select("n_rows", "smallest_class", F.greatest(F.lit(2), folds).cast("bigint").alias("folds"))


def _fold_starts(n: int, folds: int) -> list[int]:
    """First rank of each fold but the first; the first n % folds folds are one longer."""
    sizes = [n // folds + (1 if i < n % folds else 0) for i in range(folds)]
    return [r for r in (sum(sizes[:i]) for i in range(1, folds)) if r < n]


def assign_folds(
    df: DataFrame, keys: Sequence[str], folds: int, target: str | None = None, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Add the fold number of each row: equal parts in hash order, per class when a target is given."""
    keys = row_keys(df, keys, [target])
    if target is not None:
        def ranks(n: Column) -> Column:
            starts = F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), lambda i: i * F.floor(n / folds) + F.least(i, n % folds))
            return F.filter(starts, lambda r: r < n) if folds > 1 else F.array().cast("array<bigint>")

        return fit_class_cuts(df, target, keys, ranks, seed).attach(df, name)
    starts = _fold_starts(df.count(), folds)
    return Cuts(tuple(keys), seed, hashes_at_ranks(df, hash_key(keys, seed), {None: starts})[None]).attach(df, name)


def sample_rows(df: DataFrame, keys: Sequence[str] = (), rows: int = 100, seed: int = 42) -> DataFrame:
    """The same rows at every partitioning: the first ones in hash order, as a top-k without a full sort."""
    return df.withColumn("_h", hash_key(row_keys(df, keys), seed)).orderBy("_h").limit(rows).drop("_h")

"""Distinct values of categorical columns: counts, modes, sorted codes and the join that applies them.

All start from one long value-count table. Counting combines on the map side, so a value that holds
a third of the rows costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableloom.functions.columns import col
from tableloom.session import local_table, materialize

#: Levels, and bytes of their texts, that go to the driver as literals' source.
LOCAL_LEVELS = 10_000
LOCAL_BYTES = 32_000_000
#: Levels, and bytes of their texts, that a lookup broadcasts.
BROADCAST_LEVELS = 200_000
BROADCAST_BYTES = 64_000_000
LARGEST_INT_CODE = 2**31 - 1
ONE_TASK_LEVELS = 200_000
RANGE_PARTS = 1_000
HOT_SHARE = 0.001
SALTS = 64


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column and distinct value (as text, NULL included) with its row count."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns
    ])
    return (
        df.select(F.explode(entries).alias("e"))
        .groupBy(F.col("e.column").alias("column"), F.col("e.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def level_summary(counts: DataFrame) -> DataFrame:
    """Distinct count and mode (smallest on ties) per column, skipping NULL; levels and rows with it."""
    ranked = F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("rank"), F.col("value")))
    return counts.groupBy("column").agg(
        F.count("value").alias("n_distinct"), F.min(ranked).getField("value").alias("mode"),
        F.count(F.lit(1)).alias("n_levels"), F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("n_bytes"),
    )


def sorted_codes(levels: DataFrame, n_levels: int) -> DataFrame:
    """Add ``code``: the position of each distinct ``value`` in sorted order, from 0.

    Few levels are numbered by one window. Many are cut into ranges at sampled values, numbered
    inside each range and shifted by the sizes of the ranges before, so no task sees them all.
    """
    if n_levels <= ONE_TASK_LEVELS:
        return levels.withColumn("code", F.row_number().over(Window.orderBy("value")) - 1)
    share = min(1.0, 20.0 * RANGE_PARTS / n_levels)
    sample = sorted(r["value"] for r in levels.select("value").sample(share, seed=1).collect())
    cuts = sample[:: max(1, len(sample) // RANGE_PARTS)]
    bounds = F.array(*[F.lit(c) for c in cuts])
    part = F.size(F.filter(bounds, lambda b: b <= F.col("value")))
    parted = levels.withColumn("part", part)
    sizes = parted.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("value")) - 1
    return (
        parted.withColumn("within", within)
        .join(F.broadcast(shifts), "part")
        .withColumn("code", F.col("shift") + F.col("within"))
        .drop("part", "within", "shift")
    )


def fits_broadcast(n_keys: int, n_bytes: int) -> bool:
    """Whether a lookup table is small by its rows and by the bytes of its keys."""
    return n_keys <= BROADCAST_LEVELS and n_bytes <= BROADCAST_BYTES


def key_bytes(table: DataFrame, key: str) -> int:
    return table.agg(F.sum(F.octet_length(col(key)))).first()[0] or 0


def lookup_join(
    df: DataFrame, value: Column, table: DataFrame, key: str, n_keys: int, n_bytes: int, hot: Sequence[str], spread: Column
) -> DataFrame:
    """Left-join a table with one row per ``key`` to ``value``, dropping the key.

    A table of a checked size is broadcast. A larger one is shuffled, with the rows of each ``hot``
    value spread over salts by ``spread`` (any hash that tells rows apart).
    """
    renamed = table.withColumnRenamed(key, "_key")
    if fits_broadcast(n_keys, n_bytes):
        return df.join(F.broadcast(renamed), value == F.col("_key"), "left").drop("_key")
    hot = list(hot)
    last_salt = F.when(F.col("_key").isin(hot), SALTS - 1).otherwise(0) if hot else F.lit(0)
    salt = F.when(value.isin(hot), F.pmod(spread, F.lit(SALTS)).cast("int")).otherwise(0) if hot else F.lit(0)
    salted = renamed.withColumn("_salt", F.explode(F.sequence(F.lit(0), last_salt)))
    keyed = df.withColumns({"_value": value, "_row_salt": salt})
    match = (F.col("_value") == F.col("_key")) & (F.col("_row_salt") == F.col("_salt"))
    return keyed.join(salted, match, "left").drop("_value", "_row_salt", "_key", "_salt")


def hot_values(counts: DataFrame, key: str, n_rows: int) -> tuple[str, ...]:
    """Values with more than HOT_SHARE of the rows; at most 1 / HOT_SHARE can qualify."""
    rows = counts.where(F.col("n") > HOT_SHARE * n_rows).select(key).collect()
    return tuple(r[key] for r in rows)


@dataclass(frozen=True)
class CodeTable:
    """Sorted codes of one column. ``hot`` lists the values that hold a large share of the rows."""

    column: str
    codes: DataFrame
    n_levels: int
    n_bytes: int
    hot: tuple[str, ...]

    def attach(self, df: DataFrame, value: Column, as_name: str, spread: Column) -> DataFrame:
        codes = self.codes.select("value", F.col("code").alias(as_name))
        return lookup_join(df, value, codes, "value", self.n_levels, self.n_bytes, self.hot, spread)


def local_code_table(spark: SparkSession, column: str, values: Sequence[str | None], null_level: str) -> CodeTable:
    """Codes of a column whose few levels are already on the driver."""
    levels = sorted({null_level if v is None else v for v in values}, key=lambda v: v.encode())
    codes = local_table(spark, value=pa.array(levels, pa.string()), code=pa.array(range(len(levels)), pa.int32()))
    return CodeTable(column, codes, len(levels), sum(len(v.encode()) for v in levels), ())


def code_table(counts: DataFrame, column: str, n_levels: int, n_rows: int, null_level: str) -> CodeTable:
    """Codes for one column of a value-count table; NULL is coded like the text ``null_level``."""
    levels = (
        counts.where(F.col("column") == column)
        .groupBy(F.coalesce("value", F.lit(null_level)).alias("value"))
        .agg(F.sum("n").alias("n"))
    )
    # Codes stay int as long as they fit.
    kind = "int" if n_levels <= LARGEST_INT_CODE else "bigint"
    codes = materialize(sorted_codes(levels, n_levels).select("value", F.col("code").cast(kind).alias("code")))
    n_bytes = key_bytes(codes, "value")
    hot = () if fits_broadcast(n_levels, n_bytes) else hot_values(levels, "value", n_rows)
    return CodeTable(column, codes, n_levels, n_bytes, hot)

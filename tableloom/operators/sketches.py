"""Profiles that can be merged: sketches of distinct values and quantiles per batch of rows.

A stored sketch stands for its rows, so the profile of many batches (days, files, partitions of a table) is a merge of
small binaries and never a second read. Distinct counts are HyperLogLog sketches, quantiles KLL sketches; both
merge in any order, and their errors do not grow with the rows or the number of merges.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.columns import col

#: Logarithm of the buckets of a distinct-count sketch; three standard errors are within DISTINCT_ERROR.
BUCKETS_LOG = 14
DISTINCT_ERROR = 0.025
#: Size of a quantile sketch; the rank of a quantile is within RANK_ERROR of its share with 99 % confidence.
QUANTILE_SIZE = 800
RANK_ERROR = 0.005

SKETCH_COLUMNS = ["column", "n_rows", "n_present", "low", "high", "distinct_sketch", "quantile_sketch"]


def sketch_columns(df: DataFrame, columns: Sequence[str] | None = None, batch: Sequence[str] = ()) -> DataFrame:
    """One row per batch (the values of the ``batch`` columns; one in all without them) and column, with its sketches.

    Quantiles and ends are of numbers only. The sketches are summed on the map side, so a batch costs a row a task.
    """
    chosen = list(columns or [c for c in df.columns if c not in batch])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    measures, rows = [F.count(F.lit(1)).alias("n_rows")], []
    for i, c in enumerate(chosen):
        number = isinstance(kinds[c], T.NumericType)
        value = col(c).cast("double") if number else F.lit(None).cast("double")
        measures += [
            F.count(col(c)).alias(f"present_{i}"), F.min(value).alias(f"low_{i}"), F.max(value).alias(f"high_{i}"),
            F.hll_sketch_agg(col(c).cast("string"), F.lit(BUCKETS_LOG)).alias(f"distinct_{i}"),
        ]
        measures += [F.kll_sketch_agg_double(value, F.lit(QUANTILE_SIZE)).alias(f"quantile_{i}")] if number else []
        quantile = F.when(F.col(f"present_{i}") > 0, F.col(f"quantile_{i}")) if number else F.lit(None).cast("binary")
        rows.append(F.struct(
            F.lit(c).alias("column"), F.col("n_rows"), F.col(f"present_{i}").alias("n_present"), F.col(f"low_{i}").alias("low"),
            F.col(f"high_{i}").alias("high"), F.col(f"distinct_{i}").alias("distinct_sketch"), quantile.alias("quantile_sketch")))
    found = df.groupBy(*[col(b) for b in batch]).agg(*measures)
    return found.select(*[col(b) for b in batch], F.inline(F.array(*rows)))


def merge_sketches(*tables: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per column (and value of the ``by`` columns) from the sketches of any batches."""
    names = [*by, *SKETCH_COLUMNS]
    stacked = reduce(DataFrame.unionByName, [t.select(*[col(n) for n in names]) for t in tables])
    return stacked.groupBy(*[col(b) for b in by], "column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_present").alias("n_present"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def approximate_summary(sketches: DataFrame) -> DataFrame:
    """Per row of sketches: ``n_distinct`` and the bounds ``at_least`` and ``at_most`` that its error allows, with ``n_missing``."""
    estimate = F.hll_sketch_estimate("distinct_sketch")
    kept = [c for c in sketches.columns if c not in SKETCH_COLUMNS]
    return sketches.select(
        *[col(c) for c in kept], "column", estimate.alias("n_distinct"),
        F.floor(estimate * (1 - DISTINCT_ERROR)).alias("at_least"), F.ceil(estimate * (1 + DISTINCT_ERROR)).alias("at_most"),
        (F.col("n_rows") - F.col("n_present")).alias("n_missing"),
    )


def sketch_quantile(share: float) -> Column:
    """The quantile of a merged row; its ends are exact."""
    if share <= 0:
        return F.col("low")
    if share >= 1:
        return F.col("high")
    present = (F.col("n_present") > 0) & F.col("low").isNotNull()
    return F.when(present, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(share))))


def sketch_quantiles(sketches: DataFrame, shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Approximate quantiles per column: a value whose rank is within RANK_ERROR of the share."""
    found = sketches.select("column", *[sketch_quantile(s).alias(f"q{i}") for i, s in enumerate(shares)]).collect()
    return {r["column"]: [r[f"q{i}"] for i in range(len(shares))] for r in found}

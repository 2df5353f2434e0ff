"""What the target column looks like and which task it makes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.columns import col

CLASSIFICATION, REGRESSION = "classification", "regression"

# More than half the rows distinct means regression; the margin is ten times the estimate's error.
ESTIMATE_ERROR, CLEARLY_DISTINCT, SMALL_TARGET = 0.01, 0.6, 100_000


def target_profile(df: DataFrame, target: str) -> DataFrame:
    """One row about the target's distinct values. Distinct counts skip NULL, the row count does not."""
    counts = df.groupBy(col(target).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    present = F.col("y").isNotNull()
    numeric = isinstance(df.schema[target].dataType, T.NumericType)
    number = F.col("y").cast("double") if numeric else F.lit(None).cast("double")
    found = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_if(present).alias("n_distinct"),
        F.count_if(present & (F.col("n") == 1)).alias("singletons"),
        F.max(F.when(present, F.col("n"))).alias("largest"),
        F.min(number).alias("low"),
        F.max(number).alias("high"),
        F.coalesce(F.every(number == F.floor(number)), F.lit(False)).alias("all_integer"),
    )
    low, distinct = F.col("low"), F.col("n_distinct")
    runs = low.isin(0.0, 1.0) & (F.col("high") == distinct + low - 1)
    return found.select(
        "n_rows",
        "n_distinct",
        F.try_divide(distinct, F.col("n_rows")).alias("unique_ratio"),
        F.coalesce(F.try_divide(F.col("singletons"), distinct), F.lit(0.0)).alias("singleton_ratio"),
        F.try_divide(F.col("largest"), F.col("n_rows")).alias("modal_share"),
        "all_integer",
        F.coalesce(F.col("all_integer") & runs, F.lit(False)).alias("sequential"),
        F.lit(isinstance(df.schema[target].dataType, (T.StringType, T.BooleanType))).alias("categorical"),
    )


def task_rule() -> Column:
    """Task by the first rule that holds, on the columns of ``target_profile``."""
    distinct = F.col("n_distinct")
    by_sequence = F.when(distinct <= 50, CLASSIFICATION).otherwise(REGRESSION)
    return (
        F.when(F.col("unique_ratio") > 0.9, REGRESSION)
        .when(distinct > 0.5 * F.col("n_rows"), REGRESSION)
        .when(F.col("singleton_ratio") > 0.5, REGRESSION)
        .when(F.col("categorical"), F.when(distinct > 100, REGRESSION).otherwise(CLASSIFICATION))
        .when(distinct <= 20, CLASSIFICATION)
        .when(F.col("all_integer") & (F.col("unique_ratio") < 0.05) & (distinct <= 100), CLASSIFICATION)
        .when(F.col("sequential"), by_sequence)
        .when((F.col("modal_share") > 0.05) & (distinct <= 50), CLASSIFICATION)
        .otherwise(REGRESSION)
    )


def detect_task(df: DataFrame, target: str) -> DataFrame:
    return target_profile(df, target).select(F.lit(target).alias("target"), "n_rows", "n_distinct", task_rule().alias("task"))


def task_of(df: DataFrame, target: str) -> str:
    """The task alone. Where distinct values clearly outnumber half the rows, an estimate (1 % error)
    settles it without shuffling the target column; elsewhere the exact rules decide."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(col(target), ESTIMATE_ERROR).alias("distinct")
    ).first()
    if row["rows"] > SMALL_TARGET and row["distinct"] > CLEARLY_DISTINCT * row["rows"]:
        return REGRESSION
    return detect_task(df, target).first()["task"]

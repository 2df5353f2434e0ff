"""Checks that stop training on a target that cannot be learnt, and removal of one-row classes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.columns import col

MIN_TRAIN_ROWS = 10


class TrainingError(ValueError):
    """The training rows cannot carry the asked task."""


def training_verdict(train: DataFrame, target: str, task: str) -> DataFrame:
    """One row with the counts and the verdict: ok, remove_singletons or the reason to stop."""
    counts = train.groupBy(col(target).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    present = F.col("y").isNotNull()
    found = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("train_rows"),
        F.count_if(present).alias("classes"),
        F.count_if(present & (F.col("n") == 1)).alias("singletons"),
    )
    return found.withColumn("verdict", verdict_rule(task))


def verdict_rule(task: str) -> Column:
    rows, classes, single = F.col("train_rows"), F.col("classes"), F.col("singletons")
    few = F.when(rows < MIN_TRAIN_ROWS, "too_few_rows")
    if task != "classification":
        return few.otherwise("ok")
    return (
        few.when(classes > 0.8 * rows, "too_many_classes")
        .when(single > 0.5 * classes, "mostly_singletons")
        .when((single > 0) & (single >= 0.3 * classes), "too_many_singletons")
        .when((single > 0) & (rows - single < MIN_TRAIN_ROWS), "too_few_rows_after_removal")
        .when(single > 0, "remove_singletons")
        .otherwise("ok")
    )


@dataclass(frozen=True)
class Verdict:
    train_rows: int
    classes: int
    singletons: int
    verdict: str

    def check(self) -> None:
        if self.verdict not in ("ok", "remove_singletons"):
            raise TrainingError(
                f"{self.verdict}: {self.train_rows} training rows, {self.classes} classes, "
                f"{self.singletons} of them with one row; pass task='regression' if the target is a quantity"
            )


def check_target(df: DataFrame, target: str, task: str) -> None:
    """Stop with the cause before anything is trained: missing targets, or a text as a quantity."""
    if task != "classification" and not isinstance(df.schema[target].dataType, (T.NumericType, T.BooleanType)):
        raise TrainingError(f"text_target: {target!r} is no number; pass task='classification' to learn its values as classes")
    missing = df.where(col(target).isNull()).count()
    if missing:
        raise TrainingError(f"missing_target: {missing} rows have no {target!r}; remove or fill them before training")


def judge(train: DataFrame, target: str, task: str) -> Verdict:
    if task != "classification":
        # Only the rows matter here, so a continuous target is not grouped.
        rows = train.count()
        return Verdict(rows, 0, 0, "too_few_rows" if rows < MIN_TRAIN_ROWS else "ok")
    return Verdict(**training_verdict(train, target, task).first().asDict())


def remove_singletons(train: DataFrame, other: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Drop the classes that have one training row, from the training rows and from the others.

    The classes are as large as they come, so the join's kind is left to adaptive execution.
    """
    counts = train.groupBy(col(target).alias("_single")).agg(F.count(F.lit(1)).alias("n"))
    singles = counts.where((F.col("n") == 1) & F.col("_single").isNotNull()).select("_single")
    match = col(target) == F.col("_single")
    return train.join(singles, match, "left_anti"), other.join(singles, match, "left_anti")

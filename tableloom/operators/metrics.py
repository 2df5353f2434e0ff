"""Scores of predictions against the truth, as aggregates over the prediction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.functions.columns import col


def classification_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Accuracy, precision, recall and F1 in one row, from confusion counts.

    With two classes in the truth the greatest label is the positive one; otherwise the per-class
    scores are weighted by support. A ratio with zero below the line counts as 0.
    """
    confusion = df.groupBy(col(truth).alias("y"), col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("chosen"), hit.alias("hits")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("chosen"), F.lit(0).cast("bigint").alias("hits")),
    )
    labels = (
        confusion.select(F.inline(sides)).groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("chosen").alias("chosen"), F.sum("hits").alias("hits"))
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    scored = labels.select(
        "label", "support", "hits",
        ratio(F.col("hits"), F.col("chosen")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("support") + F.col("chosen")).alias("f1_score"),
    )
    names = ("precision", "recall", "f1_score")
    in_truth = F.when(F.col("support") > 0, F.col("label"))
    summed = scored.agg(
        F.count(in_truth).alias("classes"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        *[F.max_by(name, in_truth).alias(f"positive_{name}") for name in names],
        *[(F.sum(F.col(name) * F.col("support")) / F.sum("support")).alias(f"weighted_{name}") for name in names],
    )
    binary = F.col("classes") == 2
    return summed.select("accuracy", *[
        F.when(binary, F.col(f"positive_{name}")).otherwise(F.col(f"weighted_{name}")).alias(name) for name in names
    ])


def regression_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Mean squared and absolute error, its root and the explained share, in one aggregate."""
    y, p = col(truth).cast("double"), col(predicted).cast("double")
    found = df.agg(
        F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"), F.var_pop(y).alias("spread")
    )
    constant = F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    explained = F.when(F.col("spread") == 0, constant).otherwise(1 - F.try_divide(F.col("mse"), F.col("spread")))
    return found.select("mse", F.sqrt("mse").alias("rmse"), "mae", explained.alias("r2_score"))


def score_name(task: str) -> str:
    return "accuracy" if task == "classification" else "r2_score"


def evaluate(df: DataFrame, truth: str, predicted: str, task: str) -> DataFrame:
    measure = classification_metrics if task == "classification" else regression_metrics
    return measure(df, truth, predicted)

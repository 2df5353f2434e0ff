"""The tables a report is made of, as projections of the preparation and training results."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.operators.models import Tournament
from tableloom.session import local_table

# What each task's metric table shows.
CLASSIFICATION_METRICS = ["accuracy", "precision", "recall", "f1_score", "cv_mean"]
REGRESSION_METRICS = ["r2_score", "rmse", "mae", "cv_mean"]


def overview(metadata: DataFrame) -> DataFrame:
    """Rows and columns before and after, and duplicates removed, in one row."""
    names = {
        "original_rows": ("input", "rows"), "original_columns": ("input", "columns"),
        "final_rows": ("output", "rows"), "final_columns": ("output", "columns"),
        "duplicates_removed": ("duplicates", "removed"),
    }
    return metadata.where(F.col("column").isNull()).agg(*[
        F.max(F.when((F.col("stage") == stage) & (F.col("metric") == metric), F.col("value").cast("bigint"))).alias(name)
        for name, (stage, metric) in names.items()
    ])


def deltas(metadata: DataFrame) -> DataFrame:
    return overview(metadata).select(
        "original_rows", (F.col("final_rows") - F.col("original_rows")).alias("row_change"),
        "final_columns", (F.col("final_columns") - F.col("original_columns")).alias("column_change"),
        "duplicates_removed",
    )


def missing_handled(missing: DataFrame, rows: int = 10) -> DataFrame:
    """The first columns, in table order, that had missing values."""
    return missing.orderBy("position").limit(rows).select("column", "missing")


def outlier_summary(outliers: DataFrame, rows: int = 10) -> DataFrame:
    """Among the first columns, in table order, those with outliers."""
    return outliers.orderBy("position").limit(rows).where("outliers > 0").select("column", "outliers")


def training_summary(result: Tournament) -> DataFrame:
    return local_table(
        result.metrics.sparkSession, task=pa.array([result.task]), target=pa.array([result.target]),
        train_rows=pa.array([result.train_rows]), test_rows=pa.array([result.test_rows]),
        best_model=pa.array([result.best.name]), best_score=pa.array([float(result.best_score)]),
    )


def metric_table(metrics: DataFrame, task: str) -> DataFrame:
    names = CLASSIFICATION_METRICS if task == "classification" else REGRESSION_METRICS
    wide = metrics.groupBy("ordinal", "model").pivot("metric", names).agg(F.first("value"))
    return wide.orderBy("ordinal").select("model", *names)


def top_importance(importance: DataFrame, rows: int = 15) -> DataFrame:
    return importance.orderBy("rank").limit(rows)


def preparation_facts(metadata: DataFrame, missing: DataFrame) -> DataFrame:
    """Engineered-feature count, duplicates removed and the first five columns that were imputed."""
    change = deltas(metadata)
    first = missing.orderBy("position").limit(5)
    return (
        change.select(F.lit("data").alias("section"), F.lit("engineered_features").alias("name"), F.col("column_change").cast("string").alias("value"))
        .unionByName(change.select(F.lit("data").alias("section"), F.lit("duplicates_removed").alias("name"), F.col("duplicates_removed").cast("string").alias("value")))
        .unionByName(first.select(F.lit("missing").alias("section"), F.col("column").alias("name"), F.col("missing").cast("string").alias("value")))
    )


def model_facts(result: Tournament) -> DataFrame:
    """Task, target, sizes, the best model with its score, every model's two leading metrics, the
    five most important features, and what failed, as (section, name, value)."""
    spark = result.metrics.sparkSession
    trained = result.metrics.where("metric <> 'failed'").select("model").distinct().count()
    known = {
        "task": result.task, "target": result.target, "models": str(trained),
        "train_rows": str(result.train_rows), "test_rows": str(result.test_rows),
        result.best.name: f"{result.best_score:.4f}",
    }
    head = local_table(
        spark, section=pa.array(["model"] * len(known) + ["failed"] * len(result.failures)),
        name=pa.array([*known, *result.failures]), value=pa.array([*known.values(), *result.failures.values()]))
    leading = ["accuracy", "f1_score"] if result.task == "classification" else ["r2_score", "rmse"]
    scores = result.metrics.where(F.col("metric").isin(leading)).select(
        F.lit("scores").alias("section"), F.concat_ws(" ", "model", "metric").alias("name"), F.format_string("%.4f", "value").alias("value"))
    weights = result.importance(5).select(
        F.lit("importance").alias("section"), F.col("feature").alias("name"), F.format_string("%.4f", "importance").alias("value"))
    return head.unionByName(scores).unionByName(weights)


def summary_facts(metadata: DataFrame, missing: DataFrame, result: Tournament | None = None) -> DataFrame:
    facts = preparation_facts(metadata, missing)
    return facts if result is None else facts.unionByName(model_facts(result))


def missing_of(metadata: DataFrame, order: Mapping[str, int]) -> DataFrame:
    """The missing counts recorded at fit time, with the columns' positions."""
    position = F.try_element_at(F.create_map(*[F.lit(x) for pair in order.items() for x in pair]), F.col("column"))
    return metadata.where("stage = 'missing'").select("column", F.col("value").cast("bigint").alias("missing"), position.alias("position"))

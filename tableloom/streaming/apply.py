"""Applying a fitted plan to rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tableloom.plans.prepare import PreparePlan


def transform_stream(plan: PreparePlan, stream: DataFrame) -> DataFrame:
    """Every stage but duplicate removal and nearest-neighbour filling works row by row, so the plan's
    literals apply to a stream.

    A value that was not there at fit time gets a NULL code instead of stopping the stream. Filling
    from nearest neighbours searches the fitted table by jobs of its own, which a stream cannot start.
    """
    if plan.neighbours is not None:
        raise ValueError(
            "a plan fitted with missing_strategy='knn' cannot run on a stream; fit it with 'median', "
            "or apply it to each micro-batch with foreachBatch")
    return plan.transform(stream, deduplicate=False, unseen="null")


def write_stream(prepared: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return prepared.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    )

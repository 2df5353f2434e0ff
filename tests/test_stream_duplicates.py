"""Duplicate removal on file streams: micro-batches, restarts and expiry."""

import pytest
from pyspark.sql import functions as F

from tableloom.streaming.duplicates import first_rows

SCHEMA = "at timestamp, user bigint, kind string, part int"


def feed(spark, folder, rows):
    df = spark.createDataFrame([(p, *r) for p, r in enumerate(rows)], "n int, at string, user bigint, kind string, part int")
    df.select(F.to_timestamp("at").alias("at"), "user", "kind", "part").coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    kept = first_rows(stream, ["user", "kind"], **options)
    query = kept.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted((tuple(r) for r in spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")).select("user", "kind", "part").collect()), key=repr)


def test_first_rows_stay_over_batches_and_a_restart(spark, tmp_path):
    folder = str(tmp_path / "in")
    feed(spark, folder, [("2024-01-01", 1, "a", 0), ("2024-01-01", 1, "b", 0), ("2024-01-02", None, "a", 0)])
    assert run(spark, tmp_path) == [(1, "a", 0), (1, "b", 0), (None, "a", 0)]
    feed(spark, folder, [("2024-01-01", 1, "a", 1), ("2024-01-03", 2, "a", 1), ("2024-01-03", None, "a", 1)])
    feed(spark, folder, [("2024-01-04", 2, "a", 2), ("2024-01-04", 2, None, 2), ("2024-01-04", 2, None, 2)])
    assert run(spark, tmp_path) == [(1, "a", 0), (1, "b", 0), (2, "a", 1), (2, None, 2), (None, "a", 0)]


def test_keys_expire_behind_the_watermark(spark, tmp_path):
    folder = str(tmp_path / "in")
    options = {"time": "at", "expiry": "1 hour"}
    feed(spark, folder, [("2024-01-01 10:00:00", 1, "a", 0)])
    run(spark, tmp_path, **options)
    feed(spark, folder, [("2024-01-01 10:30:00", 1, "a", 1), ("2024-01-01 15:00:00", 2, "b", 1)])
    assert run(spark, tmp_path, **options) == [(1, "a", 0), (2, "b", 1)]
    feed(spark, folder, [("2024-01-01 16:00:00", 1, "a", 2), ("2024-01-01 15:10:00", 2, "b", 2)])
    assert run(spark, tmp_path, **options) == [(1, "a", 0), (1, "a", 2), (2, "b", 1)]


def test_arguments_are_checked(spark):
    batch = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="no columns"):
        first_rows(batch, ["user", "color"])
    with pytest.raises(ValueError, match="event time"):
        first_rows(batch, ["user"], time="at")

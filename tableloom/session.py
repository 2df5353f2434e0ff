"""Session defaults, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

#: What each application keeps, in the order it was kept: paths of written tables, and persisted frames.
_kept: dict[str, list[str | DataFrame]] = {}


def build_session(app: str = "tableloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Call-site capture costs several driver round trips per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for name, value in {**defaults, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names, or None where it names none."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder. Only a local session may fall back to a temporary one."""
    base = checkpoint_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tableloom-")
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def kept(spark: SparkSession) -> list[str | DataFrame]:
    return _kept.setdefault(spark.sparkContext.applicationId, [])


def materialize(df: DataFrame) -> DataFrame:
    """Keep an intermediate result that several later jobs read.

    With a shared folder it is written there as a table: lineage is cut, a lost executor costs a
    re-read, and each later job reads only the columns it needs. Without one it is persisted, and
    lost blocks are recomputed.
    """
    spark = df.sparkSession
    if checkpoint_dir(spark) is None:
        held = df.persist(StorageLevel.MEMORY_AND_DISK)
        kept(spark).append(held)
        return held
    return write_kept(df, "kept")


def write_kept(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the shared folder and read it back; ``clear_kept`` deletes it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    kept(spark).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_kept(spark: SparkSession, since: int = 0) -> int:
    """Delete or unpersist what this application has kept, or only what came after the first ``since``.

    Call it when no result that reads the tables is used any more.
    """
    held, removed = kept(spark), 0
    while len(held) > since:
        entry = held.pop()
        if isinstance(entry, str):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(entry)
            removed += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
        else:
            entry.unpersist()
            removed += 1
    return removed


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Give a small frame whose rows are costly to compute (model scores) one partition per core."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *columns)


def spread_few(df: DataFrame) -> DataFrame:
    """Spread rows that are costly to compute on and come in fewer partitions than cores, as from a file of one row group.

    For scans and what follows them in one stage: counting the partitions of a frame with shuffles would run these.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def local_table(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    """A small driver-side table as a local relation: no job reads it and it broadcasts at once."""
    return spark.createDataFrame(pa.table(columns))

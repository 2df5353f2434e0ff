"""Reading and writing tables, missing-value tokens, type inference and the target column."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.columns import col, nan_to_null
from tableloom.sources.csv_ranges import read_csv_ranges

# The texts a delimited file uses for a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# The texts read as booleans.
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]

INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|inf|infinity)\s*$"

READERS = {".csv": "csv", ".parquet": "parquet"}


def _format_of(path: str) -> str:
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in READERS:
        raise ValueError(f"unsupported format {suffix!r} of {path}; supported: {', '.join(READERS)}")
    return READERS[suffix]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system the path belongs to, local or shared."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return filesystem.exists(hadoop_path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """Read CSV (with header) or parquet. A missing path or another suffix is an error before the read.

    Without a schema a CSV costs one extra pass that infers the column types. Quoted texts may hold line
    breaks: a pass over the files finds which ranges begin inside quotes. ``multi_line=False`` saves that pass for
    files known to have none.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no data at {path}")
    if _format_of(path) == "parquet":
        return nan_to_null(spark.read.parquet(path))
    if multi_line:
        raw = read_csv_ranges(spark, path)
    else:
        raw = spark.read.csv(path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if schema is None:
        return infer_types(raw)
    types = {f.name: f.dataType for f in schema.fields}
    return nan_to_null(raw.select(*[_typed(null_tokens(col(c)), types[c]).alias(c) for c in raw.columns if c in types]))


def write_table(df: DataFrame, path: str, mode: str = "error") -> str:
    """Write CSV (with header) or parquet as a folder; parent folders are created."""
    writer = df.write.mode(mode)
    if _format_of(path) == "csv":
        # Outer spaces stay, and line breaks travel inside quotes.
        writer.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    else:
        writer.parquet(path)
    return path


def null_tokens(text: Column) -> Column:
    return F.when(~text.isin(NA_TOKENS), text)


def _typed(text: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.when(text.isin(TRUE_TOKENS), True).when(text.isin(FALSE_TOKENS), False)
    return text if isinstance(dtype, T.StringType) else text.try_cast(dtype)


def inferred_types(df: DataFrame) -> dict[str, T.DataType]:
    """The narrowest type every present text of a column fits, by one aggregate over all columns.

    Whole numbers are bigint, or double when some are missing; booleans must have none missing.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return {}
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(texts):
        value = null_tokens(col(name))
        is_integer = value.rlike(INTEGER_TEXT) & value.try_cast("bigint").isNotNull()
        measures += [
            F.count(value).alias(f"present_{i}"),
            F.count_if(is_integer).alias(f"integer_{i}"),
            F.count_if(value.rlike(NUMBER_TEXT)).alias(f"number_{i}"),
            F.count_if(value.isin(TRUE_TOKENS + FALSE_TOKENS)).alias(f"boolean_{i}"),
        ]
    seen = df.agg(*measures).first()
    chosen: dict[str, T.DataType] = {}
    for i, name in enumerate(texts):
        present, complete = seen[f"present_{i}"], seen[f"present_{i}"] == seen["rows"]
        if present == 0:
            chosen[name] = T.DoubleType()
        elif seen[f"integer_{i}"] == present:
            chosen[name] = T.LongType() if complete else T.DoubleType()
        elif seen[f"number_{i}"] == present:
            chosen[name] = T.DoubleType()
        elif seen[f"boolean_{i}"] == present and complete:
            chosen[name] = T.BooleanType()
        else:
            chosen[name] = T.StringType()
    return chosen


def infer_types(df: DataFrame) -> DataFrame:
    """Map missing-value tokens to NULL and cast every text column to its inferred type."""
    types = inferred_types(df)
    return df.select(
        *[_typed(null_tokens(col(c)), types[c]).alias(c) if c in types else col(c) for c in df.columns]
    )


def resolve_target(df: DataFrame, target: str | None = None) -> str:
    """The named target, or the last column; an unknown name is an error."""
    if target is None:
        return df.columns[-1]
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found; available: {', '.join(df.columns)}")
    return target


def feature_columns(df: DataFrame, target: str, keys: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c != target and c not in keys]

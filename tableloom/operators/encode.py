"""Encoding of categorical columns: indicators for few levels, sorted codes for many."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.functions.columns import col, column_kinds
from tableloom.operators.levels import (
    LOCAL_BYTES, LOCAL_LEVELS, CodeTable, code_table, level_summary, local_code_table, value_counts,
)
from tableloom.session import materialize

NULL_LEVEL = "nan"


def encoding_policy(df: DataFrame, threshold: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """``onehot`` up to the threshold of distinct values, else ``label``."""
    columns = list(columns or column_kinds(df).categorical)
    rule = F.when(F.col("n_distinct") <= threshold, "onehot").otherwise("label")
    return level_summary(value_counts(df, columns)).select("column", "n_distinct", rule.alias("encoding"))


@dataclass(frozen=True)
class Encoding:
    """``onehot`` holds the sorted levels per column, ``label`` the code table per column."""

    onehot: dict[str, list[str]] = field(default_factory=dict)
    label: dict[str, CodeTable] = field(default_factory=dict)
    order: tuple[str, ...] = ()

    @property
    def map(self) -> dict[str, str]:
        return {c: "onehot" if c in self.onehot else "label" for c in self.order}

    def transform(self, df: DataFrame, unseen: str = "error") -> DataFrame:
        """Codes replace their column in place; indicators (first level left out) go to the end.

        A value that was not there at fit time is an error, or NULL with ``unseen='null'``.
        """
        spread = F.xxhash64(*[col(c) for c in df.columns])
        names = df.columns
        for c, table in self.label.items():
            value = F.coalesce(col(c), F.lit(NULL_LEVEL))
            df = table.attach(df, value, "_code", spread)
            code = F.col("_code")
            if unseen == "error":
                message = F.concat(F.lit(f"unseen value in column {c}: "), value)
                code = F.when(code.isNull(), F.raise_error(message).cast("int")).otherwise(code)
            df = df.withColumn(c, code).drop("_code")
        indicators = [
            F.coalesce(col(c) == level, F.lit(False)).alias(f"{c}_{level}")
            for c, levels in self.onehot.items() for level in levels[1:]
        ]
        return df.select(*[col(c) for c in names if c not in self.onehot], *indicators)


def fit_encoding(df: DataFrame, columns: Sequence[str] | None = None, threshold: int = 10) -> Encoding:
    """One value-count job over all categorical columns decides and feeds both encodings."""
    columns = list(column_kinds(df).categorical if columns is None else columns)
    if not columns:
        return Encoding()
    counts = materialize(value_counts(df, columns))
    summary = {r["column"]: r for r in level_summary(counts).collect()}
    few = [c for c in columns if summary[c]["n_distinct"] <= threshold]
    # Columns' levels come to the driver, smallest first, while all of them together stay small.
    local, taken = list(few), sum(summary[c]["n_bytes"] for c in few)
    for c in sorted((c for c in columns if c not in few), key=lambda c: summary[c]["n_bytes"]):
        if summary[c]["n_levels"] <= LOCAL_LEVELS and taken + summary[c]["n_bytes"] <= LOCAL_BYTES:
            local.append(c)
            taken += summary[c]["n_bytes"]
    levels: dict[str, list[str | None]] = {c: [] for c in local}
    if local:
        for r in counts.where(F.col("column").isin(local)).select("column", "value").collect():
            levels[r["column"]].append(r["value"])
    onehot = {c: sorted((v for v in levels[c] if v is not None), key=lambda v: v.encode()) for c in few}
    label = {}
    for c in columns:
        if c in onehot:
            continue
        if c in levels:
            label[c] = local_code_table(df.sparkSession, c, levels[c], NULL_LEVEL)
        else:
            label[c] = code_table(counts, c, summary[c]["n_levels"], summary[c]["n_rows"], NULL_LEVEL)
    return Encoding(onehot, label, tuple(columns))


def onehot_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Indicators for the given columns whatever their number of levels under the default policy."""
    return fit_encoding(df, columns).transform(df)


def label_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fit_encoding(df, columns, threshold=-1).transform(df)

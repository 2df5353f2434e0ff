"""Column references, column kinds and small numeric expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class Kinds:
    numeric: list[str]
    categorical: list[str]
    datetime: list[str]
    other: list[str]

    def of(self, name: str) -> str:
        for kind in ("numeric", "categorical", "datetime"):
            if name in getattr(self, kind):
                return kind
        return "other"


def column_kinds(df: DataFrame, exclude: Iterable[str] = ()) -> Kinds:
    """Numbers, texts and dates by type; booleans and nested types are none of the three."""
    kinds = Kinds([], [], [], [])
    skip = set(exclude)
    for field in df.schema.fields:
        if field.name in skip:
            continue
        if isinstance(field.dataType, T.NumericType):
            kinds.numeric.append(field.name)
        elif isinstance(field.dataType, (T.StringType, T.CharType, T.VarcharType)):
            kinds.categorical.append(field.name)
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kinds.datetime.append(field.name)
        else:
            kinds.other.append(field.name)
    return kinds


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN compares above every number and equal to itself in Spark, so it becomes NULL once, at input."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(col(c)), col(c)) for c in floats})


def clip(c: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a number on one or both sides. NULL stays NULL (greatest and least skip nulls)."""
    bounded = c
    if lower is not None:
        bounded = F.greatest(F.lit(float(lower)), bounded)
    if upper is not None:
        bounded = F.least(F.lit(float(upper)), bounded)
    return F.when(c.isNotNull(), bounded)


def weighted_score(terms: Sequence[tuple[float, Column, float, float]]) -> Column:
    """Sum of weight * (value - low) / span over (weight, value, low, span) terms."""
    total = F.lit(0.0)
    for weight, value, low, span in terms:
        total = total + F.lit(float(weight)) * (value - F.lit(float(low))) / F.lit(float(span))
    return total


def threshold_label(score: Column, threshold: float = 0.5) -> Column:
    return (score > F.lit(float(threshold))).cast("int")


def map_values(c: Column, mapping: Mapping[str, float]) -> Column:
    """Look a category up in a literal map; unknown categories give NULL."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def day_of_week(c: Column) -> Column:
    """Monday is 0."""
    return F.weekday(c)


def is_weekend(c: Column) -> Column:
    return (F.weekday(c) >= 5).cast("int")


def null_every(c: Column, key: Column, modulus: int, remainder: int) -> Column:
    """Blank a fixed share of the rows, chosen by key."""
    return F.when(F.pmod(key, F.lit(modulus)) != remainder, c)

"""Scaling and derived numeric features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.columns import col
from tableloom.operators.quantiles import quantiles


@dataclass(frozen=True)
class Scaling:
    """Centre and (non-zero) scale per column."""

    centers: dict[str, float]
    scales: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.centers:
            return df
        return df.withColumns({c: (col(c) - m) / self.scales[c] for c, m in self.centers.items()})


def standard_measures(columns: Sequence[str]) -> list[Column]:
    return [
        *[F.avg(col(c)).alias(f"mean_{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(col(c)).alias(f"dev_{i}") for i, c in enumerate(columns)],
    ]


def standard_from(row, columns: Sequence[str]) -> Scaling:
    """Mean and population deviation; a column that does not vary keeps scale 1."""
    present = [(i, c) for i, c in enumerate(columns) if row[f"mean_{i}"] is not None]
    return Scaling({c: row[f"mean_{i}"] for i, c in present}, {c: row[f"dev_{i}"] or 1.0 for i, c in present})


def fit_standard(df: DataFrame, columns: Sequence[str]) -> Scaling:
    return standard_from(df.agg(*standard_measures(columns)).first(), columns) if columns else Scaling({}, {})


def fit_robust(
    df: DataFrame, columns: Sequence[str], counts: Mapping[str, int] | None = None, approximate: bool = False
) -> Scaling:
    found = quantiles(df, columns, [0.25, 0.5, 0.75], counts, approximate)
    present = {c: q for c, q in found.items() if q[1] is not None}
    return Scaling({c: q[1] for c, q in present.items()}, {c: (q[2] - q[0]) or 1.0 for c, q in present.items()})


def pair_product(a: str, b: str) -> Column:
    return (col(a) * col(b)).alias(f"{a}_x_{b}")


def pair_ratio(a: str, b: str) -> Column:
    return F.try_divide(col(a), col(b) + F.lit(1e-8)).alias(f"{a}_div_{b}")


def square(c: str) -> Column:
    return (col(c) * col(c)).alias(f"{c}_squared")


def log_magnitude(c: str) -> Column:
    return F.log1p(F.abs(col(c))).alias(f"{c}_log")


def derived_columns(numeric: Sequence[str], pairs: int = 3, singles: int = 5) -> list[Column]:
    """Products and ratios of the first adjacent pairs, squares and logs of the first columns."""
    derived: list[Column] = []
    for a, b in list(zip(numeric, numeric[1:]))[:pairs]:
        derived += [pair_product(a, b), pair_ratio(a, b)]
    for c in numeric[:singles]:
        derived += [square(c), log_magnitude(c)]
    return derived


def derive(df: DataFrame, numeric: Sequence[str], pairs: int = 3, singles: int = 5) -> DataFrame:
    return df.select("*", *derived_columns(numeric, pairs, singles))

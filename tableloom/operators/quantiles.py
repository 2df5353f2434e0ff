"""Exact interpolated quantiles of whole columns at any row count.

``percentile`` keeps a value-to-count map per column in a single task, which is fine for few rows or
few distinct values. Otherwise each quantile is bracketed by approximate percentiles, the brackets
are checked by counting, and only rows inside a bracket are looked at again. That is one pass for guesses,
one that confirms them and one for the values; each further narrowing by about accuracy / 4, needed from
some hundred million distinct values on, takes two more. Rows are never shuffled whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tableloom.functions.columns import col

DIRECT_ROWS = 100_000
FEW_VALUES = 20_000
BRACKET_VALUES = 200_000
ACCURACY, COARSE_ACCURACY = 10_000, 1_000
COARSE_ROWS = 50_000_000
COLUMNS_PER_JOB = 50


def _as_double(name: str) -> Column:
    return col(name).cast("double")


Measures = Mapping[str, Callable[[Column], Column]]


def present_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    row = df.agg(*[F.count(col(c)).alias(f"n_{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"n_{i}"] for i, c in enumerate(columns)}


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    counts: Mapping[str, int] | None = None,
    approximate: bool = False,
    direct_rows: int = DIRECT_ROWS,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; NULLs are skipped, an empty column gives None."""
    columns, probs = list(columns), list(probs)
    if not columns:
        return {}
    if approximate:
        return _one_pass(df, columns, lambda c: F.percentile_approx(c, probs, ACCURACY))
    if counts is None:
        return quantiles_and_measures(df, columns, probs, {}, direct_rows)[0]
    small = [c for c in columns if counts[c] <= direct_rows]
    large = [c for c in columns if counts[c] > direct_rows]
    found = _one_pass(df, small, lambda c: F.percentile(c, probs)) if small else {}
    for start in range(0, len(large), COLUMNS_PER_JOB):
        part = large[start : start + COLUMNS_PER_JOB]
        coarse = max(counts[c] for c in part) <= COARSE_ROWS
        found |= narrowed_quantiles(df, part, probs, COARSE_ACCURACY if coarse else ACCURACY)
    return {c: found[c] if found[c] is not None else [None] * len(probs) for c in columns}


def quantiles_and_measures(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], measures: Measures, direct_rows: int = DIRECT_ROWS
) -> tuple[dict[str, list[float | None]], dict[tuple[str, str], float]]:
    """Quantiles of columns whose counts are not known yet, with other aggregates from the first pass.

    Besides ``measures`` the second result holds ``count``, ``min`` and ``max`` of each column.
    """
    found, seen = {}, {}
    for start in range(0, len(columns), COLUMNS_PER_JOB):
        part = list(columns[start : start + COLUMNS_PER_JOB])
        values, first = _narrowed(df, part, list(probs), measures, COARSE_ACCURACY, BRACKET_VALUES, FEW_VALUES, direct_rows)
        found |= values
        seen |= first
    return found, seen


def _one_pass(df: DataFrame, columns: list[str], measure) -> dict[str, list[float] | None]:
    row = df.agg(*[measure(_as_double(c)).alias(f"q_{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"q_{i}"] for i, c in enumerate(columns)}


@dataclass
class _Bracket:
    """Values from low to high hold the ranks first and last (0-based) of one quantile."""

    column: str
    first: int
    last: int
    low: float
    high: float
    below: int
    inside: int
    distinct: int

    def holds(self) -> Column:
        return _as_double(self.column).between(self.low, self.high)


def narrowed_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    accuracy: int = ACCURACY,
    bracket_values: int = BRACKET_VALUES,
    few_values: int = FEW_VALUES,
) -> dict[str, list[float]]:
    return _narrowed(df, list(columns), list(probs), {}, accuracy, bracket_values, few_values, 0)[0]


def _narrowed(
    df: DataFrame, columns: list[str], probs: list[float], measures: Measures, accuracy: int, bracket_values: int,
    few_values: int, direct_rows: int,
) -> tuple[dict[str, list[float | None]], dict[tuple[str, str], float]]:
    """First pass: counts, ends, guesses and the other measures. Second: ``percentile`` of columns with
    few rows or values, and counts that confirm the others' brackets. Then narrower brackets while a
    bracket holds too many values, and the values at the ranks."""
    guesses = [g for p in probs for g in _around(p, p, accuracy)]
    aggregates = []
    for i, c in enumerate(columns):
        value = _as_double(c)
        aggregates += [
            F.percentile_approx(value, guesses, accuracy).alias(f"guess_{i}"), F.approx_count_distinct(value).alias(f"distinct_{i}"),
            F.count(value).alias(f"count_{i}"), F.min(value).alias(f"min_{i}"), F.max(value).alias(f"max_{i}"),
            *[measure(value).alias(f"{name}_{i}") for name, measure in measures.items()],
        ]
    row = df.agg(*aggregates).first()
    seen = {(name, c): row[f"{name}_{i}"] for i, c in enumerate(columns) for name in ("count", "min", "max", *measures)}
    brackets: dict[tuple[str, float], _Bracket] = {}
    first_guess, few = [], []
    for i, c in enumerate(columns):
        n = seen["count", c]
        if n <= direct_rows or row[f"distinct_{i}"] <= few_values:
            few.append(c)
            continue
        for j, p in enumerate(probs):
            position = (n - 1) * p
            brackets[c, p] = _Bracket(c, math.floor(position), math.ceil(position), seen["min", c], seen["max", c], 0, n, n)
            first_guess.append((row[f"guess_{i}"][2 * j], row[f"guess_{i}"][2 * j + 1]))
    pending = list(brackets.values())
    exact = [F.percentile(_as_double(c), probs).alias(f"exact_{i}") for i, c in enumerate(few)]
    second = _confirm(df, pending, first_guess, exact) if pending or exact else None
    result = {c: second[f"exact_{i}"] or [None] * len(probs) for i, c in enumerate(few)}
    while pending := [b for b in pending if b.low < b.high and b.distinct > bracket_values]:
        _confirm(df, pending, _guess(df, pending, accuracy))
    values = _values_at_ranks(df, list(brackets.values()))
    for (c, p), bracket in brackets.items():
        lower, upper = values[c, bracket.first], values[c, bracket.last]
        share = (seen["count", c] - 1) * p - bracket.first
        result.setdefault(c, []).append(lower + (upper - lower) * share)
    return result, seen


def _around(low: float, high: float, accuracy: int) -> list[float]:
    """Percentages surely outside the wanted ones, given the error of an approximate percentile."""
    margin = 2.0 / accuracy
    return [max(low - margin, 0.0), min(high + margin, 1.0)]


def _guess(df: DataFrame, pending: list[_Bracket], accuracy: int) -> list[tuple[float, float]]:
    measures = []
    for i, b in enumerate(pending):
        span = max(b.inside - 1, 1)
        ends = _around((b.first - b.below) / span, (b.last - b.below) / span, accuracy)
        inside = F.when(b.holds(), _as_double(b.column))
        measures.append(F.percentile_approx(inside, ends, accuracy).alias(f"g_{i}"))
    row = df.agg(*measures).first()
    return [tuple(row[f"g_{i}"]) for i in range(len(pending))]


def _confirm(df: DataFrame, pending: list[_Bracket], guesses: list[tuple[float, float]], extra: Sequence[Column] = ()) -> Row:
    """Shrink every bracket to its guessed ends, keeping only the ends that counting confirms.

    Returns the row of the pass, with any extra aggregates.
    """
    checks = list(extra)
    for i, (b, (low, high)) in enumerate(zip(pending, guesses)):
        value, within = _as_double(b.column), b.holds()
        checks += [
            F.count_if(within & (value < low)).alias(f"below_{i}"),
            F.count_if(within & (value > high)).alias(f"above_{i}"),
            F.approx_count_distinct(F.when(value.between(low, high), value)).alias(f"distinct_{i}"),
        ]
    seen = df.agg(*checks).first()
    for i, (b, (low, high)) in enumerate(zip(pending, guesses)):
        below, above = seen[f"below_{i}"], seen[f"above_{i}"]
        low_holds = b.below + below <= b.first
        high_holds = b.below + b.inside - above > b.last
        narrower = (low_holds and below > 0) or (high_holds and above > 0)
        if low_holds:
            b.low, b.below, b.inside = low, b.below + below, b.inside - below
        if high_holds:
            b.high, b.inside = high, b.inside - above
        if low_holds and high_holds:
            b.distinct = seen[f"distinct_{i}"]
        if not narrower:
            # Only repeated values are left between the ends, so few distinct ones remain.
            b.distinct = 0
    return seen


def _values_at_ranks(df: DataFrame, brackets: list[_Bracket]) -> dict[tuple[str, int], float]:
    """Read the values at the wanted ranks from value counts inside the (small) brackets."""
    found: dict[tuple[str, int], float] = {}
    open_brackets = []
    for b in brackets:
        if b.low == b.high:
            found[b.column, b.first] = found[b.column, b.last] = b.low
        else:
            open_brackets.append(b)
    if not open_brackets:
        return found
    entries = F.array_compact(
        F.array(*[
            F.when(b.holds(), F.struct(F.lit(i).alias("bracket"), _as_double(b.column).alias("value")))
            for i, b in enumerate(open_brackets)
        ])
    )
    counted = (
        df.select(F.explode(entries).alias("e"))
        .groupBy(F.col("e.bracket").alias("bracket"), F.col("e.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    running = Window.partitionBy("bracket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.sum("n").over(running)
    ranks = F.lit(False)
    for i, b in enumerate(open_brackets):
        for rank in {b.first - b.below, b.last - b.below}:
            covers = (F.col("reached") - F.col("n") <= rank) & (F.col("reached") > rank)
            ranks = ranks | ((F.col("bracket") == i) & covers)
    for row in counted.withColumn("reached", reached).where(ranks).collect():
        b = open_brackets[row["bracket"]]
        for rank in (b.first, b.last):
            if row["reached"] - row["n"] <= rank - b.below < row["reached"]:
                found[b.column, rank] = row["value"]
    return found

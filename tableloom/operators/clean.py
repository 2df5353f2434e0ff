"""Cleaning stages. ``fit_*`` reads statistics from one table; ``transform`` applies them to any."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.columns import clip, col, column_kinds
from tableloom.operators.levels import level_summary, value_counts
from tableloom.operators.quantiles import quantiles


@dataclass(frozen=True)
class MissingCounts:
    rows: int
    missing: dict[str, int]

    @property
    def total(self) -> int:
        return sum(self.missing.values())

    def present(self, column: str) -> int:
        return self.rows - self.missing[column]

    def sparse(self, threshold: float = 0.5) -> list[str]:
        """Columns whose missing share is above the threshold, or that hold nothing at all."""
        return [
            c for c, n in self.missing.items()
            if n > 0 and (n > threshold * self.rows or n == self.rows)
        ]


def count_missing(df: DataFrame, columns: Sequence[str]) -> MissingCounts:
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(col(c)).alias(f"n_{i}") for i, c in enumerate(columns)]
    ).first()
    return MissingCounts(row["rows"], {c: row["rows"] - row[f"n_{i}"] for i, c in enumerate(columns)})


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5, exclude: Sequence[str] = ()) -> DataFrame:
    columns = [c for c in df.columns if c not in exclude]
    return df.drop(*count_missing(df, columns).sparse(threshold))


@dataclass(frozen=True)
class Fill:
    """Values for missing cells. Filled numeric columns become double."""

    numeric: dict[str, float] = field(default_factory=dict)
    categorical: dict[str, str] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        filled = {c: F.coalesce(col(c).cast("double"), F.lit(v)) for c, v in self.numeric.items()}
        filled |= {c: F.coalesce(col(c), F.lit(v)) for c, v in self.categorical.items()}
        return df.withColumns(filled) if filled else df


def fit_median(
    df: DataFrame, columns: Sequence[str], counts: Mapping[str, int] | None = None, approximate: bool = False
) -> Fill:
    found = quantiles(df, columns, [0.5], counts, approximate)
    return Fill(numeric={c: v[0] for c, v in found.items() if v[0] is not None})


def fit_mode(df: DataFrame, columns: Sequence[str]) -> Fill:
    if not columns:
        return Fill()
    modes = level_summary(value_counts(df, columns)).collect()
    return Fill(categorical={r["column"]: r["mode"] for r in modes if r["mode"] is not None})


def drop_duplicates(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), carried: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct combination of ``columns``; keys and carried columns come from the row
    with the lowest key.

    A grouped minimum combines on the map side, so a third of the rows being one copied row costs
    nothing in the shuffle (a window would sort the whole group in one task). Keys are expected to be
    unique; rows equal in key and ``columns`` give any of their carried values.
    """
    others = [c for c in carried if c not in keys]
    rest = [*keys, *others]
    groups = df.groupBy(*[col(c) for c in columns])
    if not rest:
        return df.select(*[col(c) for c in columns]).distinct()
    if len(rest) == 1:
        kept = groups.agg(F.min(col(rest[0])).alias(rest[0]))
    elif (packed := _packed_keys(df, keys, others)) is not None:
        # One number per row keeps the aggregate in hash maps, which a minimum of structs would sort for.
        number, unpacked = packed
        found = groups.agg(F.min(number).alias("_key"), *[F.min_by(col(c), number).alias(c) for c in others])
        kept = found.select(*[col(c) for c in columns], *[value.alias(k) for k, value in unpacked.items()], *[col(c) for c in others])
    else:
        kept = groups.agg(F.min(F.struct(*[col(c) for c in rest])).alias("_first"))
        kept = kept.select(*[col(c) for c in columns], *[F.col("_first").getField(c).alias(c) for c in rest])
    return kept.select(*[col(c) for c in df.columns if c in columns or c in rest])


def _packed_keys(df: DataFrame, keys: Sequence[str], others: Sequence[str]) -> tuple[Column, dict[str, Column]] | None:
    """Integer keys as one number in their order (NULL first), and the keys from that number ``_key``.

    None where a key is no integer, the ranges need more than 62 bits, or a carried column has no fixed width.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    whole, fixed = (T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
    if not keys or not all(isinstance(types[k], whole) for k in keys) or not all(isinstance(types[c], fixed) for c in others):
        return None
    ends = df.agg(*[f(col(k)).alias(f"{n}_{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    lows = [ends[f"lo_{i}"] or 0 for i in range(len(keys))]
    bits = [((ends[f"hi_{i}"] or 0) - low + 1).bit_length() for i, low in enumerate(lows)]
    if sum(bits) > 62:
        return None
    number, place = F.lit(0).cast("bigint"), sum(bits)
    unpacked = {}
    for k, low, width in zip(keys, lows, bits):
        place -= width
        part = F.coalesce(col(k).cast("bigint") - F.lit(low - 1), F.lit(0).cast("bigint"))
        number = number.bitwiseOR(F.shiftleft(part, place))
        own = F.shiftright("_key", place).bitwiseAND(F.lit((1 << width) - 1))
        unpacked[k] = F.when(own > 0, own + F.lit(low - 1)).cast(types[k])
    return number, unpacked


@dataclass(frozen=True)
class Fences:
    """Lower and upper bound per column; values strictly outside are outliers."""

    bounds: dict[str, tuple[float, float]]

    def is_outlier(self, name: str) -> Column:
        low, high = self.bounds[name]
        return (col(name) < low) | (col(name) > high)

    def counts(self) -> list[Column]:
        return [F.count_if(self.is_outlier(c)).alias(c) for c in self.bounds]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.capped()) if self.bounds else df

    def capped(self) -> dict[str, Column]:
        return {c: clip(col(c).cast("double"), *b) for c, b in self.bounds.items()}


def fit_iqr(
    df: DataFrame, columns: Sequence[str], counts: Mapping[str, int] | None = None, approximate: bool = False
) -> Fences:
    bounds = {}
    for c, (q1, q3) in quantiles(df, columns, [0.25, 0.75], counts, approximate).items():
        if q1 is not None:
            bounds[c] = (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    return Fences(bounds)


@dataclass(frozen=True)
class ZScore:
    """Sample mean and deviation per column. A column that does not vary has no outliers."""

    moments: dict[str, tuple[float | None, float | None]]
    limit: float = 3.0

    def score(self, name: str) -> Column:
        mean, deviation = self.moments[name]
        return F.abs((col(name) - mean) / deviation)

    def _varies(self, name: str) -> bool:
        return bool(self.moments[name][1])

    def is_outlier(self, name: str) -> Column:
        return self.score(name) > self.limit if self._varies(name) else F.lit(False)

    def keeps(self, name: str) -> Column:
        """NULL rows are not kept: their score is not at or below the limit."""
        return self.score(name) <= self.limit if self._varies(name) else F.lit(True)

    def counts(self) -> list[Column]:
        return [F.count_if(self.is_outlier(c)).alias(c) for c in self.moments]

    def transform(self, df: DataFrame) -> DataFrame:
        for c in self.moments:
            df = df.where(self.keeps(c))
        return df


def fit_zscore(df: DataFrame, columns: Sequence[str], limit: float = 3.0) -> ZScore:
    """Moments of all columns over the same rows, in one aggregate: for counting without removal."""
    if not columns:
        return ZScore({}, limit)
    row = df.agg(
        *[F.avg(col(c)).alias(f"m_{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(col(c)).alias(f"s_{i}") for i, c in enumerate(columns)],
    ).first()
    return ZScore({c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(columns)}, limit)


def fit_zscore_sequential(
    df: DataFrame, columns: Sequence[str], limit: float = 3.0
) -> tuple[ZScore, dict[str, int]]:
    """Moments of each column over the rows that earlier columns kept, with the outliers met on the way.

    Each column's moments depend on the rows before it, so this takes one aggregate per column; the
    rows themselves are never moved, only filtered by literals. The count for a column rides on the
    aggregate of the next one.
    """
    moments: dict[str, tuple[float | None, float | None]] = {}
    outliers: dict[str, int] = {}
    rows, previous = df, None
    for c in [*columns, None]:
        fitted = ZScore(dict(moments), limit)
        survives = F.lit(True) if previous is None else fitted.keeps(previous)
        measures = []
        if previous is not None:
            measures.append(F.count_if(fitted.is_outlier(previous)).alias("outliers"))
        if c is not None:
            value = F.when(survives, col(c))
            measures += [F.avg(value).alias("mean"), F.stddev_samp(value).alias("deviation")]
        if not measures:
            break
        row = rows.agg(*measures).first()
        if previous is not None:
            outliers[previous] = row["outliers"]
            rows = rows.where(survives)
        if c is not None:
            moments[c] = (row["mean"], row["deviation"])
        previous = c
    return ZScore(moments, limit), outliers


def outlier_counts(df: DataFrame, method: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Count outliers per numeric column without changing any row."""
    columns = list(columns or column_kinds(df).numeric)
    fitted = (fit_iqr(df, columns) if method == "iqr" else fit_zscore(df, columns)) if columns else Fences({})
    names = list(fitted.moments if isinstance(fitted, ZScore) else fitted.bounds)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, outliers bigint, position int")
    wide = df.agg(*fitted.counts())
    structs = [F.struct(F.lit(c).alias("column"), col(c).alias("outliers"), F.lit(i).alias("position")) for i, c in enumerate(names)]
    return wide.select(F.inline(F.array(*structs)))

"""Profiles of a table: each function returns one small DataFrame, from one pass where possible."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.columns import col, column_kinds
from tableloom.operators.levels import level_summary, value_counts
from tableloom.operators.moments import correlation_matrix
from tableloom.operators.quantiles import quantiles, quantiles_and_measures
from tableloom.operators.sketches import BUCKETS_LOG
from tableloom.session import local_table

MEASURES_PER_JOB = 200
#: The most common value and NULL, among so many counted items.
FREQUENT_ITEMS = 2
FREQUENT_COUNTERS = 10_000

DESCRIBE_SCHEMA = "column string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
BOX_SCHEMA = "column string, q1 double, median double, q3 double, whisker_low double, whisker_high double, fliers bigint"
HISTOGRAM_SCHEMA = "column string, bin bigint, bin_low double, bin_high double, n bigint"
STATISTICS_SCHEMA = "column string, mean double, median double, std double, min double, max double, skewness double, kurtosis double"

# Bytes of one stored value by type; texts are measured.
TYPE_WIDTHS = {
    T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}


def long_table(wide: DataFrame, rows: Sequence[Sequence[tuple[str, Column]]]) -> DataFrame:
    """Turn a one-row aggregate into one row per list of (name, expression) pairs."""
    structs = [F.struct(*[value.alias(name) for name, value in row]) for row in rows]
    return wide.select(F.inline(F.array(*structs)))


def no_rows(df: DataFrame, schema: str) -> DataFrame:
    """What a profile gives for a table without columns of its kind."""
    return df.sparkSession.createDataFrame([], schema)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))


def kinds_table(df: DataFrame) -> DataFrame:
    """Kind of every column with the number of values it holds."""
    kinds = column_kinds(df)
    wide = df.agg(*[F.count(col(c)).alias(f"n_{i}") for i, c in enumerate(df.columns)])
    return long_table(wide, [
        [("column", F.lit(c)), ("kind", F.lit(kinds.of(c))), ("present", F.col(f"n_{i}"))]
        for i, c in enumerate(df.columns)
    ])


def _missing_wide(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)])


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, in one aggregate; columns without any are left out."""
    return long_table(_missing_wide(df), [
        [("column", F.lit(c)), ("missing", F.col(f"n_{i}")), ("position", F.lit(i))]
        for i, c in enumerate(df.columns)
    ]).where("missing > 0")


def missing_ranking(df: DataFrame) -> DataFrame:
    """Columns by missing values, most first, each beside the grand total."""
    total = sum((F.col(f"n_{i}") for i in range(1, len(df.columns))), F.col("n_0"))
    table = long_table(_missing_wide(df), [
        [("column", F.lit(c)), ("missing", F.col(f"n_{i}")), ("total", total)] for i, c in enumerate(df.columns)
    ])
    return table.where("missing > 0").orderBy(F.desc("missing"), "column")


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of the numeric columns."""
    columns = list(columns or column_kinds(df).numeric)
    if not columns:
        return no_rows(df, DESCRIBE_SCHEMA)
    found, seen = quantiles_and_measures(df, columns, [0.25, 0.5, 0.75], {"mean": F.avg, "std": F.stddev_samp})
    doubles = {name: [seen[name, c] for c in columns] for name in ("mean", "std", "min")}
    doubles |= {name: [found[c][j] for c in columns] for j, name in enumerate(("q25", "q50", "q75"))}
    doubles["max"] = [seen["max", c] for c in columns]
    return local_table(
        df.sparkSession, column=pa.array(columns, pa.string()),
        count=pa.array([seen["count", c] for c in columns], pa.int64()),
        **{name: pa.array(values, pa.float64()) for name, values in doubles.items()},
    )


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values and the most common one, ``N/A`` for an empty column.

    ``approximate`` counts distinct values by sketches, which shuffles a row a task instead of every value, and finds
    the most common value among frequent items only.
    """
    columns = list(columns or column_kinds(df).categorical)
    if not columns:
        return no_rows(df, "column string, n_distinct bigint, most_common string")
    if approximate:
        return _approximate_categories(df, columns)
    summary = level_summary(value_counts(df, columns))
    return summary.select("column", "n_distinct", F.coalesce("mode", F.lit("N/A")).alias("most_common"))


def _approximate_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    measures, rows = [], []
    for i, c in enumerate(columns):
        text = col(c).cast("string")
        present = F.count(text).alias(f"present_{i}")
        measures += [present, F.hll_sketch_estimate(F.hll_sketch_agg(text, F.lit(BUCKETS_LOG))).alias(f"n_{i}")]
        measures.append(F.call_function("approx_top_k", text, F.lit(FREQUENT_ITEMS), F.lit(FREQUENT_COUNTERS)).alias(f"top_{i}"))
        known = F.filter(f"top_{i}", lambda t: t["item"].isNotNull())
        rows.append([("column", F.lit(c)), ("n_distinct", F.col(f"n_{i}")), ("most_common", F.when(
            F.col(f"present_{i}") > 0, F.get(known, F.lit(0))["item"].cast("string")).otherwise("N/A"))])
    return long_table(df.agg(*measures), rows)


def preview(df: DataFrame, keys: Sequence[str], rows: int = 100) -> DataFrame:
    return df.orderBy(*[col(k) for k in keys]).limit(rows)


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every column pair, rows with either missing left out pair by pair.

    The pairs of few columns are measures of one aggregate; more are sums of matrix products, in one pass as well.
    """
    columns = list(columns or column_kinds(df).numeric)
    if not columns:
        return no_rows(df, "a string, b string, r double")
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    if len(pairs) > MEASURES_PER_JOB:
        found = correlation_matrix(df, [col(c) for c in columns])
        n = len(columns)
        return local_table(
            df.sparkSession, a=pa.array([c for c in columns for _ in range(n)], pa.string()), b=pa.array(columns * n, pa.string()),
            r=pa.array(found.ravel(), pa.float64(), from_pandas=True))
    measures, rows = [], []
    for i, (a, b) in enumerate(pairs):
        x, y = col(a).cast("double"), col(b).cast("double")
        # Spelled out so that a column that does not vary gives NULL where corr would fail.
        spread = F.sqrt(F.var_pop(F.when(y.isNotNull(), x))) * F.sqrt(F.var_pop(F.when(x.isNotNull(), y)))
        measures.append(F.try_divide(F.covar_pop(x, y), spread).alias(f"r_{i}"))
        rows.append([("a", F.lit(a)), ("b", F.lit(b)), ("r", F.col(f"r_{i}"))])
        if a != b:
            rows.append([("a", F.lit(b)), ("b", F.lit(a)), ("r", F.col(f"r_{i}"))])
    return long_table(df.agg(*measures), rows)


def box_plot(df: DataFrame, columns: Sequence[str] | None = None, limit: int = 10) -> DataFrame:
    """Quartiles, whiskers at the last values inside 1.5 times the quartile range, and flier counts.

    ``limit`` bounds the default choice of columns only.
    """
    columns = list(columns or column_kinds(df).numeric[:limit])
    if not columns:
        return no_rows(df, BOX_SCHEMA)
    found = quantiles(df, columns, [0.25, 0.5, 0.75])
    measures, rows = [], []
    for i, c in enumerate(columns):
        q1, q2, q3 = found[c]
        if q1 is None:
            continue
        reach = 1.5 * (q3 - q1)
        value = col(c).cast("double")
        within = F.when(value.between(q1 - reach, q3 + reach), value)
        measures += [
            F.least(F.min(within), F.lit(q1)).alias(f"low_{i}"),
            F.greatest(F.max(within), F.lit(q3)).alias(f"high_{i}"),
            F.count_if((value < q1 - reach) | (value > q3 + reach)).alias(f"fliers_{i}"),
        ]
        rows.append([
            ("column", F.lit(c)), ("q1", F.lit(q1)), ("median", F.lit(q2)), ("q3", F.lit(q3)),
            ("whisker_low", F.col(f"low_{i}")), ("whisker_high", F.col(f"high_{i}")), ("fliers", F.col(f"fliers_{i}")),
        ])
    return long_table(df.agg(*measures), rows) if rows else no_rows(df, BOX_SCHEMA)


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 30, limit: int = 4) -> DataFrame:
    """Equal-width bin counts, the last bin closed, empty bins kept. ``limit`` bounds the default columns."""
    columns = list(columns or column_kinds(df).numeric[:limit])
    if not columns:
        return no_rows(df, HISTOGRAM_SCHEMA)
    ends = df.agg(
        *[F.min(col(c).cast("double")).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(col(c).cast("double")).alias(f"hi_{i}") for i, c in enumerate(columns)],
    ).first()
    binned, frames = [], []
    for i, c in enumerate(columns):
        low, high = ends[f"lo_{i}"], ends[f"hi_{i}"]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        binned.append((c, _bin_number(col(c).cast("double"), low, high, bins).alias(c)))
        frames.append(F.struct(F.lit(c).alias("column"), F.lit(low).alias("low"), F.lit((high - low) / bins).alias("width")))
    if not binned:
        return no_rows(df, HISTOGRAM_SCHEMA)
    names = [c for c, _ in binned]
    long = df.select(*[b for _, b in binned]).unpivot([], [col(c) for c in names], "column", "bin")
    counted = long.where("bin IS NOT NULL").groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = (
        df.sparkSession.range(1).select(F.inline(F.array(*frames)))
        .withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
    )
    return grid.join(counted, ["column", "bin"], "left").select(
        "column", "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _bin_number(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin by division, moved by one where the division rounds across a bin's end."""
    width = (high - low) / bins
    raw = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1))
    early = (value < low + raw * width).cast("bigint")
    late = ((value >= low + (raw + 1) * width) & (raw != bins - 1)).cast("bigint")
    return raw - early + late


def feature_statistics(
    df: DataFrame, target: str | None = None, columns: Sequence[str] | None = None, limit: int = 10
) -> DataFrame:
    """Location, spread, and bias-corrected skewness and excess kurtosis, by default of the first ten numbers."""
    columns = [c for c in columns if c != target] if columns else [c for c in column_kinds(df).numeric if c != target][:limit]
    if not columns:
        return no_rows(df, STATISTICS_SCHEMA)
    medians, seen = quantiles_and_measures(
        df, columns, [0.5], {"mean": F.avg, "std": F.stddev_samp, "g1": F.skewness, "g2": F.kurtosis})
    values = {name: [seen[name, c] for c in columns] for name in ("mean", "std", "min", "max")}
    values["median"] = [medians[c][0] for c in columns]
    values["skewness"] = [corrected_skewness(seen["count", c], seen["g1", c]) for c in columns]
    values["kurtosis"] = [corrected_kurtosis(seen["count", c], seen["g2", c]) for c in columns]
    order = ("mean", "median", "std", "min", "max", "skewness", "kurtosis")
    return local_table(
        df.sparkSession, column=pa.array(columns, pa.string()), **{name: pa.array(values[name], pa.float64()) for name in order}
    )


def corrected_skewness(n: int, g1: float | None) -> float | None:
    """Bias-corrected; 0 for a column that does not vary, None below three values."""
    return None if n < 3 else (g1 or 0.0) * math.sqrt(n * (n - 1)) / (n - 2)


def corrected_kurtosis(n: int, g2: float | None) -> float | None:
    if n < 4:
        return None
    return 0.0 if g2 is None else (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)


def _row_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_n`` rows and ``_blanks`` per group of equal rows, equal by two 64-bit hashes of all values.

    Only the hashes are shuffled. Two of n different rows share both with a chance of about n * n / 2**129
    (one in a hundred million for 10**15 rows).
    """
    missing = F.concat(*[F.when(col(c).isNull(), "1").otherwise("0") for c in columns])
    blanks = sum((col(c).isNull().cast("bigint") for c in columns), F.lit(0).cast("bigint"))
    values = [col(c) for c in columns]
    hashed = df.select(
        F.xxhash64(missing, *values).alias("_a"), F.xxhash64(F.lit("second"), *values[::-1], missing).alias("_b"), blanks.alias("_blanks"))
    return hashed.groupBy("_a", "_b", "_blanks").agg(F.count(F.lit(1)).alias("_n"))


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    return _row_groups(df, list(columns or df.columns)).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def quality_statistics(df: DataFrame) -> DataFrame:
    """Row, column, kind, missing and duplicate counts, and completeness in percent, in one row."""
    kinds = column_kinds(df)
    # Equal rows have equal missing counts, so both totals come from the same grouping.
    totals = _row_groups(df, df.columns).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_blanks") * F.col("_n")), F.lit(0)).alias("missing_values_total"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    cells = F.col("total_rows") * len(df.columns)
    return totals.select(
        "total_rows",
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        F.lit(len(kinds.numeric)).cast("bigint").alias("numeric_columns"),
        F.lit(len(kinds.categorical)).cast("bigint").alias("categorical_columns"),
        "missing_values_total",
        "duplicate_rows",
        F.try_divide((cells - F.col("missing_values_total")) * 100.0, cells).alias("completeness"),
    )


def completeness(df: DataFrame) -> DataFrame:
    """Share of cells that hold a value, in percent; no grouping is needed for this one."""
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(col(c)).alias(f"n_{i}") for i, c in enumerate(df.columns)])
    present = sum((F.col(f"n_{i}") for i in range(len(df.columns))), F.lit(0))
    cells = F.col("rows") * len(df.columns)
    return wide.select(
        cells.alias("cells"), (cells - present).alias("missing"),
        F.try_divide(present * 100.0, cells).alias("completeness"),
    )


def data_size(df: DataFrame) -> DataFrame:
    """Stored bytes of all present values, as bytes, KB, MB and GB."""
    sizes = []
    for field in df.schema.fields:
        width = TYPE_WIDTHS.get(type(field.dataType))
        if width is not None:
            sizes.append(F.count(col(field.name)) * width)
        else:
            text = col(field.name) if isinstance(field.dataType, T.StringType) else F.to_json(F.struct(col(field.name)))
            sizes.append(F.coalesce(F.sum(F.octet_length(text).cast("bigint")), F.lit(0)))
    total = df.agg(sum(sizes[1:], sizes[0]).alias("bytes"))
    return total.select(
        "bytes", *[(F.col("bytes") / 1024**power).alias(name) for power, name in ((1, "kb"), (2, "mb"), (3, "gb"))]
    )

"""The preparation plan: missing values, duplicates, outliers, encoding, scaling, derived features.

``fit_prepare`` reads statistics in a few aggregate jobs and returns an immutable plan of literals
(and code tables); ``transform`` is one lazy projection chain over any table with the same columns.
The target and key columns travel in the row and are never touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.functions.columns import col, column_kinds, nan_to_null
from tableloom.operators.clean import (
    Fences, Fill, MissingCounts, ZScore, count_missing, drop_duplicates, fit_iqr, fit_median, fit_mode,
    fit_zscore, fit_zscore_sequential,
)
from tableloom.operators.encode import Encoding, fit_encoding
from tableloom.operators.features import Scaling, derive, fit_robust, standard_from, standard_measures
from tableloom.operators.neighbours import NeighbourFill
from tableloom.operators.quantiles import DIRECT_ROWS
from tableloom.plans.options import PrepareOptions
from tableloom.session import local_table, materialize

METADATA_COLUMNS = ("stage", "column", "metric", "value")


@dataclass(frozen=True)
class PreparePlan:
    options: PrepareOptions
    target: str | None
    keys: tuple[str, ...]
    dropped: tuple[str, ...]
    fill: Fill
    neighbours: NeighbourFill | None
    outliers: Fences | ZScore | None
    encoding: Encoding
    scaling: Scaling
    derived_from: tuple[str, ...]
    metadata_rows: tuple[tuple[str, str | None, str, str], ...] = ()
    deduplicated: DataFrame | None = field(default=None, compare=False)
    fitted: DataFrame | None = field(default=None, compare=False)

    @property
    def carried(self) -> list[str]:
        return [*self.keys, *([self.target] if self.target else [])]

    def impute(self, df: DataFrame) -> DataFrame:
        df = nan_to_null(df).drop(*self.dropped)
        if self.neighbours is not None:
            df = self.neighbours.transform(df)
        return self.fill.transform(df)

    def deduplicate(self, df: DataFrame) -> DataFrame:
        features = [c for c in df.columns if c not in self.carried]
        return drop_duplicates(df, features, self.keys, self.carried)

    def shape(self, df: DataFrame, unseen: str = "error") -> DataFrame:
        """Outliers, encoding, scaling and derived features: row by row, no shuffle of small codes."""
        if self.outliers is not None and self.options.cap_outliers:
            df = self.outliers.transform(df)
        df = self.scaling.transform(self.encoding.transform(df, unseen))
        if not self.options.derive_features:
            return df
        return derive(df, self.derived_from, self.options.derived_pairs, self.options.derived_singles)

    def transform(self, df: DataFrame, deduplicate: bool = True, unseen: str = "error") -> DataFrame:
        """Apply the plan to a table or, with ``deduplicate=False``, to a stream."""
        df = self.impute(df)
        return self.shape(self.deduplicate(df) if deduplicate else df, unseen)

    def fitted_table(self) -> DataFrame:
        """The table the plan was fitted on, transformed; it reads the kept de-duplicated rows."""
        return self.fitted

    def metadata(self) -> DataFrame:
        """Everything recorded at fit time: stage, column, metric, value (as text)."""
        parts = zip(METADATA_COLUMNS, zip(*self.metadata_rows))
        return local_table(self.deduplicated.sparkSession, **{name: pa.array(v, pa.string()) for name, v in parts})


def fit_prepare(
    df: DataFrame, target: str | None = None, keys: Sequence[str] = (), options: PrepareOptions | None = None
) -> PreparePlan:
    options = options or PrepareOptions()
    carried = [*keys, *([target] if target else [])]
    df = nan_to_null(df)
    features = [c for c in df.columns if c not in carried]
    missing = count_missing(df, features)
    dropped, fill, neighbours = _fit_missing(df, missing, carried, options)
    plan = PreparePlan(
        options, target, tuple(keys), tuple(dropped), fill, neighbours, None, Encoding(), Scaling({}, {}), ()
    )
    current = materialize(plan.deduplicate(plan.impute(df)))
    numeric = column_kinds(current, carried).numeric
    outliers, removed, kept_rows = _fit_outliers(current, numeric, missing.rows, options)

    shaped = current
    flags = {}
    if isinstance(outliers, Fences):
        flags = {f"_outlier_{i}": outliers.is_outlier(c) for i, c in enumerate(outliers.bounds)}
        shaped = shaped.withColumns(flags) if flags else shaped
    if outliers is not None and options.cap_outliers:
        shaped = outliers.transform(shaped)
    encoding = fit_encoding(
        shaped, column_kinds(current, carried).categorical, options.onehot_threshold
    )
    encoded = encoding.transform(shaped)
    scalable = column_kinds(encoded, carried).numeric
    standard = options.scale_features and options.scaler != "robust"
    measures = [F.count(F.lit(1)).alias("rows"), *[F.count_if(col(name)).alias(name) for name in flags]]
    row = encoded.agg(*measures, *(standard_measures(scalable) if standard else [])).first()
    scaling = Scaling({}, {})
    if standard:
        scaling = standard_from(row, scalable)
    elif options.scale_features:
        scaling = fit_robust(encoded, scalable, approximate=options.approximate_quantiles)
    if flags:
        removed = {c: row[f"_outlier_{i}"] for i, c in enumerate(outliers.bounds)}

    fitted = scaling.transform(encoded.drop(*flags))
    if options.derive_features:
        fitted = derive(fitted, scalable, options.derived_pairs, options.derived_singles)
    duplicates = missing.rows - (row["rows"] if kept_rows is None else kept_rows)
    rows = _metadata(df, features, fitted, carried, encoding, missing, duplicates, removed, row["rows"])
    return PreparePlan(
        options, target, tuple(keys), tuple(dropped), fill, neighbours, outliers, encoding, scaling,
        tuple(scalable), tuple(rows), current, fitted,
    )


def _fit_missing(
    df: DataFrame, missing: MissingCounts, carried: Sequence[str], options: PrepareOptions
) -> tuple[list[str], Fill, NeighbourFill | None]:
    """The stage is left out as a whole when nothing is missing, so integers stay integers."""
    if missing.total == 0:
        return [], Fill(), None
    dropped = missing.sparse(options.missing_threshold)
    kinds = column_kinds(df, [*carried, *dropped])
    categorical = fit_mode(df, kinds.categorical).categorical
    if options.missing_strategy == "knn" and kinds.numeric:
        return dropped, Fill({}, categorical), NeighbourFill(df, tuple(kinds.numeric), options.neighbours)
    counts = {c: missing.present(c) for c in kinds.numeric}
    numeric = fit_median(df, kinds.numeric, counts, options.approximate_quantiles).numeric
    return dropped, Fill(numeric, categorical), None


def _fit_outliers(
    df: DataFrame, numeric: list[str], most_rows: int, options: PrepareOptions
) -> tuple[Fences | ZScore | None, dict[str, int], int | None]:
    """The fitted stage, its outlier counts where known already, and the row count if it was taken.

    No value is missing any more, so a table known to be small needs no count before its quantiles,
    and where no row is removed the rows are counted by the last aggregate anyway.
    """
    if options.outlier_method == "iqr":
        rows = df.count() if most_rows > DIRECT_ROWS and not options.approximate_quantiles else None
        counts = {c: most_rows if rows is None else rows for c in numeric}
        return fit_iqr(df, numeric, counts, options.approximate_quantiles), {}, rows
    if options.outlier_method == "zscore":
        if options.cap_outliers:
            return *fit_zscore_sequential(df, numeric), df.count()
        fitted = fit_zscore(df, numeric)
        return fitted, df.agg(*fitted.counts()).first().asDict() if numeric else {}, None
    return None, {}, None


def _metadata(df, features, fitted, carried, encoding, missing, duplicates, outliers, final_rows) -> list[tuple]:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kinds = column_kinds(fitted, carried)
    final_columns = [c for c in fitted.columns if c not in carried]
    rows = [("input", None, "rows", missing.rows), ("input", None, "columns", len(features))]
    rows += [("input", c, "type", types[c]) for c in features]
    rows += [("missing", c, "count", n) for c, n in missing.missing.items() if n > 0]
    rows += [("duplicates", None, "removed", duplicates)]
    rows += [("outliers", c, "count", n) for c, n in outliers.items()]
    rows += [("encoding", c, "encoding", kind) for c, kind in encoding.map.items()]
    rows += [("output", None, "rows", final_rows), ("output", None, "columns", len(final_columns))]
    rows += [("output", c, "kind", kinds.of(c)) for c in final_columns]
    return [(stage, column, metric, str(value)) for stage, column, metric, value in rows]

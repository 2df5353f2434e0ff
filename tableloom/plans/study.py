"""From a raw table to an explained model and report tables in one call."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tableloom.functions.keys import row_keys
from tableloom.operators import explain, report
from tableloom.operators.guards import check_target, judge, remove_singletons
from tableloom.operators.models import Tournament, run_tournament, trainable_features
from tableloom.operators.split import assign_folds, fold_count, smallest_class, split
from tableloom.operators.target import task_of
from tableloom.plans.options import ExplainOptions, ModelOptions, PrepareOptions
from tableloom.plans.prepare import PreparePlan, fit_prepare
from tableloom.session import clear_kept, kept, materialize
from tableloom.sources.tables import resolve_target


@dataclass(frozen=True)
class Study:
    plan: PreparePlan
    prepared: DataFrame
    result: Tournament
    tables: dict[str, DataFrame]
    first_kept: int = 0

    def release(self) -> int:
        """Delete the intermediate tables kept since the study began; its tables cannot be read afterwards."""
        return clear_kept(self.prepared.sparkSession, self.first_kept)


def train_models(
    df: DataFrame, target: str, keys: Sequence[str] = (), options: ModelOptions | None = None
) -> Tournament:
    """Task, split, checks, folds and the tournament on an already prepared table.

    Without keys the feature columns tell rows apart.
    """
    options = options or ModelOptions()
    features = trainable_features(df, [target, *keys])
    keys = row_keys(df, keys, [target])
    task = task_of(df, target) if options.task == "auto" else options.task
    check_target(df, target, task)
    parts = materialize(split(df, keys, target if task == "classification" else None, options.test_size, options.seed))
    train, test = parts.where("is_test = false").drop("is_test"), parts.where("is_test").drop("is_test")
    verdict = judge(train, target, task)
    verdict.check()
    if verdict.verdict == "remove_singletons":
        train, test = remove_singletons(train, test, target)
    stratum = target if task == "classification" else None
    smallest = smallest_class(train, target) if stratum else None
    folds = fold_count(verdict.train_rows - verdict.singletons if stratum else verdict.train_rows, smallest, options.cv_folds)
    train = assign_folds(train, keys, folds, stratum, options.seed, "_fold")
    return run_tournament(
        train, test, target, task, features, "_fold", folds, options.models or None, options.sizes, options.parallel
    )


def run_study(
    df: DataFrame, target: str | None = None, keys: Sequence[str] = (),
    prepare: PrepareOptions | None = None, model: ModelOptions | None = None,
    explained: ExplainOptions | None = None,
) -> Study:
    """Prepare, train, explain (when ``explained`` is given) and tabulate.

    The de-duplicated rows are kept once; the prepared table is a projection of them. ``release`` of the
    result deletes what the study keeps.
    """
    target = resolve_target(df, target)
    first_kept = len(kept(df.sparkSession))
    plan = fit_prepare(df, target, keys, prepare)
    prepared = plan.fitted_table()
    result = train_models(prepared, target, keys, model)
    metadata = plan.metadata()
    missing = report.missing_of(metadata, {c: i for i, c in enumerate(df.columns)})
    tables = {
        "overview": report.overview(metadata),
        "deltas": report.deltas(metadata),
        "missing_handled": report.missing_handled(missing),
        "training_summary": report.training_summary(result),
        "model_metrics": report.metric_table(result.metrics, result.task),
        "top_importance": report.top_importance(result.importance()),
        "summary_facts": report.summary_facts(metadata, missing, result),
    }
    if explained is not None:
        shapley = materialize(explain.shapley_values(
            result.best, prepared, keys, explained.rows, explained.background, explained.permutations, explained.seed
        ))
        tables["shapley_values"] = shapley
        tables["global_importance"] = explain.global_importance(shapley)
        tables["directions"] = explain.directions(shapley)
        tables["local_surrogates"] = explain.local_surrogates(
            result.best, prepared, keys, target, explained.instances, explained.samples, seed=explained.seed
        )
    return Study(plan, prepared, result, tables, first_kept)

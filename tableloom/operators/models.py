"""Model training on MLlib: the model list per task, cross-validation, the tournament, importance."""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import IllegalArgumentException
from pyspark.ml import classification, regression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.columns import col
from tableloom.operators.boosting import SoftmaxBoosting
from tableloom.operators.levels import fits_broadcast, hot_values, lookup_join, sorted_codes
from tableloom.operators.metrics import evaluate, score_name
from tableloom.operators.moments import FoldSums, fold_sums, solve_linear
from tableloom.session import local_table, materialize

log = logging.getLogger(__name__)

# Names, in tournament order.
CLASSIFIERS = ["RandomForest", "GradientBoosting", "LogisticRegression"]
REGRESSORS = ["RandomForest", "GradientBoosting", "Ridge", "Lasso"]

FEATURES, LABEL = "_features", "_label"
CLOSED_FORM_FEATURES = 4096
CELLS_PER_PARTITION = 200_000
INLINE_FEATURES = 500
#: Classes matched by a literal map; more are joined as a table.
LITERAL_LABELS = 50
#: Training rows from which a forest is set up for its passes over rows, not for few jobs.
MANY_ROWS = 50_000
#: Statistics of the nodes that a task of such a forest grows at once: they stay in a core's cache.
NODES_MB = 4
#: How a model says that it does not exist or cannot be fitted to the data. All else, such as a job that ended, is a failure of the run.
REFUSALS = (ValueError, IllegalArgumentException)


@dataclass(frozen=True)
class ModelSizes:
    trees: int = 100
    tree_depth: int = 10
    rounds: int = 100
    round_depth: int = 5
    min_leaf: int = 2
    seed: int = 42


def model_names(task: str) -> list[str]:
    return CLASSIFIERS if task == "classification" else REGRESSORS


def trainable_features(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Numbers and booleans; dates stay in the table but are not learnt from."""
    kept = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if f.name not in exclude and isinstance(f.dataType, kept)]


@dataclass(frozen=True)
class Labels:
    """The classes in sorted order; none for regression.

    Few classes are literals. More are a kept table of ``_text`` and ``_index``, of which the driver
    knows the number and the size; it is broadcast only below the bounds of every lookup.
    """

    count: int = 0
    values: list[Any] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    type: T.DataType | None = None
    table: DataFrame | None = None
    n_bytes: int = 0
    hot: tuple[str, ...] = ()

    @property
    def numeric(self) -> bool:
        return not self.count or isinstance(self.type, (T.NumericType, T.BooleanType))

    def attach(self, df: DataFrame, target: str, name: str) -> DataFrame:
        """Add the class's position (the value itself for regression); unknown classes give NULL."""
        text = col(target).cast("string")
        if not self.count:
            return df.withColumn(name, col(target).cast("double"))
        if self.table is None:
            pairs = [F.lit(x) for i, known in enumerate(self.texts) for x in (known, float(i))]
            return df.withColumn(name, F.try_element_at(F.create_map(*pairs), text))
        spread = F.xxhash64(*[col(c) for c in df.columns])
        kept = [col(c) for c in df.columns if c != name]
        joined = lookup_join(df, text, self.table, "_text", self.count, self.n_bytes, self.hot, spread)
        return joined.select(*kept, F.col("_index").alias(name))

    def restore(self, df: DataFrame, index: str, name: str) -> DataFrame:
        """Replace a class's position by the class in its own type."""
        kept = [col(c) for c in df.columns if c not in (index, name)]
        if not self.count:
            return df.select(*kept, col(index).alias(name))
        if self.table is None:
            known = F.array(*[F.lit(v).cast(self.type) for v in self.values])
            return df.select(*kept, F.element_at(known, col(index).cast("int") + 1).alias(name))
        known = F.broadcast(self.table) if fits_broadcast(self.count, self.n_bytes) else self.table
        return df.join(known, col(index) == F.col("_index"), "left").select(*kept, F.col("_text").cast(self.type).alias(name))

    def numbers(self, df: DataFrame, source: str, name: str) -> DataFrame:
        """Add the class itself as a number, or its position where it is a text."""
        return df.withColumn(name, col(source).cast("double")) if self.numeric else self.attach(df, source, name)


def fit_labels(df: DataFrame, target: str, task: str) -> Labels:
    """Number the classes in sorted order. The driver sees how many there are, and the classes themselves only if they are few."""
    if task != "classification":
        return Labels()
    kind = df.schema[target].dataType
    counts = df.select(col(target).alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    levels = materialize(counts.select("value", F.col("value").cast("string").alias("text"), "n"))
    size = levels.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.sum("n").alias("rows")).first()
    if size["n"] <= LITERAL_LABELS:
        rows = sorted(levels.collect(), key=lambda r: r["value"])
        return Labels(len(rows), [r["value"] for r in rows], [r["text"] for r in rows], kind)
    coded = sorted_codes(levels.select("value", "text"), size["n"])
    table = materialize(coded.select(F.col("text").alias("_text"), F.col("code").cast("double").alias("_index")))
    hot = () if fits_broadcast(size["n"], size["bytes"]) else hot_values(levels, "text", size["rows"])
    return Labels(size["n"], type=kind, table=table, n_bytes=size["bytes"], hot=hot)


def assembled(df: DataFrame, features: Sequence[str], keep: Sequence[Column | str]) -> DataFrame:
    """A feature vector beside the kept columns; booleans count as 0 and 1."""
    casts = df.select(*keep, *[col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(features)])
    inputs = [f"_f{i}" for i in range(len(features))]
    return VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="error").transform(casts).drop(*inputs)


def estimator(name: str, task: str, n_classes: int, n_rows: int, label_deviation: float, n_features: int, sizes: ModelSizes):
    common = {"featuresCol": FEATURES, "labelCol": LABEL}
    forest = {
        **common, "numTrees": sizes.trees, "maxDepth": sizes.tree_depth,
        "minInstancesPerNode": sizes.min_leaf, "seed": sizes.seed,
    }
    if n_rows >= MANY_ROWS:
        # Neither changes the trees. Every node of a regression sees all features, so nodes may be grown in any groups; where
        # nodes draw features their order counts, so the groups stay and rows remember the node they have come to.
        forest |= {"cacheNodeIds": True} if task == "classification" else {"maxMemoryInMB": NODES_MB}
    boosting = {
        **common, "maxIter": sizes.rounds, "maxDepth": sizes.round_depth,
        "minInstancesPerNode": sizes.min_leaf, "stepSize": 0.1, "seed": sizes.seed,
    }
    if task == "classification":
        if name == "RandomForest":
            return classification.RandomForestClassifier(**forest, featureSubsetStrategy="sqrt")
        if name == "GradientBoosting":
            binary = classification.GBTClassifier(**boosting)
            if n_classes <= 2:
                return binary
            return SoftmaxBoosting(**common, classes=n_classes, rounds=sizes.rounds, depth=sizes.round_depth, min_leaf=sizes.min_leaf)
        if name == "LogisticRegression":
            return classification.LogisticRegression(
                **common, family="auto", maxIter=1000, regParam=1.0 / n_rows, standardization=False
            )
    else:
        if name == "RandomForest":
            return regression.RandomForestRegressor(**forest, featureSubsetStrategy="all")
        if name == "GradientBoosting":
            return regression.GBTRegressor(**boosting)
        if name == "Ridge":
            # MLlib divides the penalty by the label's deviation: population under the closed form,
            # sample under the iterative solver.
            closed = n_features <= CLOSED_FORM_FEATURES
            deviation = label_deviation if closed else label_deviation * math.sqrt(n_rows / max(n_rows - 1, 1))
            return regression.LinearRegression(
                **common, solver="normal" if closed else "l-bfgs", maxIter=1000,
                regParam=deviation / n_rows, elasticNetParam=0.0, standardization=False,
            )
        if name == "Lasso":
            return regression.LinearRegression(
                **common, maxIter=1000, regParam=1.0, elasticNetParam=1.0, standardization=False
            )
    raise ValueError(f"unknown {task} model {name!r}")


@dataclass(frozen=True)
class TrainedModel:
    name: str
    task: str
    target: str
    features: list[str]
    labels: Labels
    model: Any

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """All columns of ``df`` and the predicted value (a class in its own type)."""
        if isinstance(self.model, regression.LinearRegressionModel) and len(self.features) <= INLINE_FEATURES:
            # A linear prediction is a plain sum, which stays in generated code.
            terms = [F.lit(float(w)) * col(c).cast("double") for w, c in zip(self.model.coefficients, self.features)]
            return df.withColumn(name, sum(terms, F.lit(float(self.model.intercept))))
        vectors = assembled(df, self.features, [col(c) for c in df.columns])
        scored = self.model.transform(vectors).select(*[col(c) for c in df.columns], F.col("prediction").alias("_position"))
        return self.labels.restore(scored, "_position", name)

    def output(self, vectors: DataFrame, name: str = "output", position: int | None = None) -> DataFrame:
        """The number that explanations split up: a class's probability (the last of two, else the
        first, unless a position is given); the value itself for regression."""
        if position is None:
            position = 1 if self.labels.count == 2 else 0

        scored = self.model.transform(vectors)
        if self.task != "classification":
            value = F.col("prediction")
        elif "probability" in scored.columns:
            value = F.get(vector_to_array("probability"), F.lit(position))
        else:
            value = (F.col("prediction") == float(position)).cast("double")
        return scored.select(*[col(c) for c in vectors.columns if c != FEATURES], value.alias(name))

    def importance(self, spark, top: int = 20) -> DataFrame:
        """Rank, feature and importance: split gains, else mean absolute coefficients over classes."""
        weights = importance_weights(self.model, len(self.features))
        ranked = sorted(zip(self.features, weights), key=lambda fw: (-fw[1], fw[0]))[:top]
        return local_table(
            spark, model=pa.array([self.name] * len(ranked), pa.string()),
            feature=pa.array([f for f, _ in ranked], pa.string()),
            rank=pa.array(range(1, len(ranked) + 1), pa.int32()),
            importance=pa.array([float(w) for _, w in ranked], pa.float64()),
        )


def importance_weights(model, n_features: int) -> list[float]:
    if hasattr(model, "models"):
        parts = [importance_weights(m, n_features) for m in model.models]
        return [sum(p[i] for p in parts) / len(parts) for i in range(n_features)]
    if hasattr(model, "featureImportances"):
        return [float(x) for x in model.featureImportances.toArray()]
    if hasattr(model, "coefficientMatrix"):
        return [float(x) for x in abs(model.coefficientMatrix.toArray()).mean(axis=0)]
    return [abs(float(x)) for x in model.coefficients.toArray()]


@dataclass
class Prepared:
    """Vectors of one training table, kept while the models read them many times."""

    rows: DataFrame
    n_rows: int
    deviation: float
    target: str
    task: str
    features: list[str]
    labels: Labels
    sizes: ModelSizes = field(default_factory=ModelSizes)

    def fit(self, name: str, rows: DataFrame | None = None, n_rows: int | None = None, deviation: float | None = None) -> TrainedModel:
        chosen = estimator(
            name, self.task, self.labels.count, n_rows or self.n_rows,
            self.deviation if deviation is None else deviation, len(self.features), self.sizes,
        )
        model = chosen.fit(self.rows if rows is None else rows)
        return TrainedModel(name, self.task, self.target, self.features, self.labels, model)

    def release(self) -> None:
        self.rows.unpersist()


def prepare_vectors(
    df: DataFrame, target: str, task: str, features: Sequence[str], labels: Labels | None = None,
    sizes: ModelSizes | None = None, fold: str | None = None, keep: bool = True,
) -> Prepared:
    """Vectors and labels; kept in memory and disk unless the training reads them only once or twice."""
    labels = labels or fit_labels(df, target, task)
    rows = assembled(labels.attach(df, target, LABEL), features, [col(LABEL), *([col(fold)] if fold else [])])
    if keep:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(LABEL).alias("deviation")).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = min(cores, size["n"] * len(features) // CELLS_PER_PARTITION)
    if keep and rows.rdd.getNumPartitions() < wanted:
        # Fewer partitions than cores: spread the rows once for the many passes of training.
        few, rows = rows, rows.repartition(wanted).persist(StorageLevel.MEMORY_AND_DISK)
        rows.count()
        few.unpersist()
    return Prepared(rows, size["n"], size["deviation"] or 0.0, target, task, list(features), labels, sizes or ModelSizes())


def train(
    df: DataFrame, target: str, task: str, name: str, features: Sequence[str] | None = None,
    keys: Sequence[str] = (), sizes: ModelSizes | None = None,
) -> TrainedModel:
    features = list(features or trainable_features(df, [target, *keys]))
    one_pass = name == "Ridge" and len(features) <= CLOSED_FORM_FEATURES
    prepared = prepare_vectors(df, target, task, features, sizes=sizes, keep=not one_pass)
    try:
        return prepared.fit(name)
    finally:
        prepared.release()


#: Linear models, whose folds are solved from sums of products; the last says whether absolute weights are penalised.
FROM_SUMS = {"Ridge": False, "Lasso": True}
SUMMED_FEATURES = 1_000


def summed_folds(prepared: Prepared, names: Sequence[str], fold: str) -> FoldSums | None:
    """The sums of products of every fold, where a model can be fitted from them."""
    if prepared.task == "classification" or not set(names) & set(FROM_SUMS) or len(prepared.features) > SUMMED_FEATURES:
        return None
    return fold_sums(prepared.rows, vector_to_array(FEATURES), len(prepared.features), F.col(LABEL), col(fold))


def fold_score(prepared: Prepared, name: str, fold: str, number: int, sums: FoldSums | None = None) -> float:
    """Score on one fold of the model trained on the others; a linear model needs no rows but the folds' sums."""
    if sums is not None and name in FROM_SUMS:
        return sums.r2(number, *solve_linear(sums.training(number), 1.0, FROM_SUMS[name]))
    others = prepared.rows.where(col(fold) != number)
    size = others.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(LABEL).alias("deviation")).first()
    trained = prepared.fit(name, others, size["n"], size["deviation"] or 0.0)
    scored = trained.model.transform(prepared.rows.where(col(fold) == number))
    return evaluate(scored, LABEL, "prediction", prepared.task).first()[score_name(prepared.task)]


def cross_validate(
    prepared: Prepared, names: Sequence[str], fold: str, folds: int, parallel: int = 4
) -> dict[str, list[float] | Exception]:
    """Scores per model and fold, or a model's refusal. The fits are independent jobs, so several run side by side."""
    run = _fold_task(prepared, fold, summed_folds(prepared, names, fold))
    tasks = _fold_tasks(names, folds)
    return _fold_scores(names, folds, _unbroken(tasks, _in_parallel(prepared, run, tasks, parallel)))


def _fold_tasks(names: Sequence[str], folds: int) -> list[tuple[str, int]]:
    return [(name, number) for name in names for number in range(folds)]


def _fold_task(prepared: Prepared, fold: str, sums: FoldSums | None = None):
    def run(task: tuple[str, int]) -> float | Exception:
        try:
            return fold_score(prepared, task[0], fold, task[1], sums)
        except Exception as error:  # a fold that its model refuses only costs that model the folds
            return error

    return run


def _fold_scores(names: Sequence[str], folds: int, scores: list) -> dict[str, list[float] | Exception]:
    result: dict[str, list[float] | Exception] = {}
    for i, name in enumerate(names):
        own = scores[i * folds : (i + 1) * folds]
        failed = [s for s in own if isinstance(s, Exception)]
        result[name] = failed[0] if failed else own
    return result


def _in_parallel(prepared: Prepared, run, tasks: list, parallel: int) -> list:
    spark = prepared.rows.sparkSession
    with ThreadPool(max(1, min(parallel, len(tasks)))) as pool:
        return pool.map(inheritable_thread_target(spark)(run), tasks, chunksize=1)


def _unbroken(tasks: list, results: list) -> list:
    """The results, if all errors among them are refusals; what a broken run has left out must not look like one."""
    for task, result in zip(tasks, results):
        if isinstance(result, Exception) and not isinstance(result, REFUSALS):
            what = task if isinstance(task, str) else f"fold {task[1]} of {task[0]}"
            raise RuntimeError(f"the run failed at {what}: {_cause(result)}") from result
    return results


def _cause(error: Exception) -> str:
    return str(error).splitlines()[0] if str(error) else type(error).__name__


METRIC_COLUMNS = {"ordinal": pa.int32(), "model": pa.string(), "metric": pa.string(), "value": pa.float64()}


@dataclass(frozen=True)
class Tournament:
    """All models' metrics as a long table, and the best one by test score.

    A refused model has the one metric ``failed``; one that refuses a fold has NULL for ``cv_mean`` and ``cv_std``, and ``cv_failed``.
    ``failures`` says why.
    """

    task: str
    target: str
    train_rows: int
    test_rows: int
    features: list[str]
    metrics: DataFrame
    best: TrainedModel
    best_score: float
    failures: dict[str, str] = field(default_factory=dict)

    def importance(self, top: int = 20) -> DataFrame:
        return self.best.importance(self.metrics.sparkSession, top)

    def predict(self, df: DataFrame) -> DataFrame:
        return self.best.predict(df)


def predict(tournament: Tournament | None, df: DataFrame) -> DataFrame:
    if tournament is None:
        raise ValueError("no model has been trained yet")
    return tournament.predict(df)


def run_tournament(
    train_rows: DataFrame, test_rows: DataFrame, target: str, task: str, features: Sequence[str],
    fold: str | None = None, folds: int = 0, names: Sequence[str] | None = None,
    sizes: ModelSizes | None = None, parallel: int = 4,
) -> Tournament:
    """Fit every model on the training rows, score it on the test rows and by its folds.

    A model that refuses the data stays in the table without scores; the first of equal scores wins; none left is an error, and so is
    any other failure, as of a job, in the fit, the scores or the folds of a model.
    """
    names = list(names or model_names(task))
    # A class the training rows lack cannot be predicted but still counts against the scores.
    labels = fit_labels(train_rows.select(col(target)).unionByName(test_rows.select(col(target))), target, task)
    prepared = prepare_vectors(train_rows, target, task, features, labels, sizes, fold)
    test = assembled(labels.attach(test_rows, target, LABEL), features, [col(LABEL)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_test = test.count()

        def fit(name):
            try:
                trained = prepared.fit(name)
                return trained, evaluate(trained.model.transform(test), LABEL, "prediction", task).first().asDict()
            except Exception as error:  # a model that cannot be fitted has no scores, its cause kept
                log.warning("%s was not trained: %s", name, error)
                return error

        # The final fits and all folds share one pool, so a slow model does not hold the others up.
        fold_tasks = _fold_tasks(names, folds)
        score = _fold_task(prepared, fold, summed_folds(prepared, names, fold) if folds else None)
        tasks = [*names, *fold_tasks]
        results = _unbroken(tasks, _in_parallel(
            prepared, lambda task: fit(task) if isinstance(task, str) else score(task), tasks, parallel
        ))
        fitted = dict(zip(names, results))
        scores = _fold_scores(names, folds, results[len(names):]) if folds else {}
        failed = {n: f for n, f in fitted.items() if isinstance(f, Exception)}
        failures = {n: f"not trained: {_cause(e)}" for n, e in failed.items()}
        if len(failed) == len(fitted):
            causes = "; ".join(f"{n}: {_cause(e)}" for n, e in failed.items())
            raise RuntimeError(f"no model could be trained ({causes})")
        rows, best, best_score = [], None, -math.inf
        for ordinal, name in enumerate(names):
            if name in failed:
                rows.append((ordinal, name, "failed", 1.0))
                continue
            trained, metrics = fitted[name]
            score = metrics[score_name(task)]
            folded = scores.get(name)
            mean, deviation = _mean_and_deviation(folded, score)
            entries = {**metrics, "cv_mean": mean, "cv_std": deviation}
            if isinstance(folded, Exception):
                log.warning("the folds of %s failed: %s", name, folded)
                failures[name] = f"folds failed: {_cause(folded)}"
                entries["cv_failed"] = 1.0
            for metric, value in entries.items():
                rows.append((ordinal, name, metric, None if value is None else float(value)))
            if score is not None and score > best_score:
                best, best_score = trained, score
        if best is None:
            raise RuntimeError(f"no trained model has a {score_name(task)}: the {n_test} test rows give no score")
        table = local_table(train_rows.sparkSession, **{
            name: pa.array(values, kind) for (name, kind), values in zip(METRIC_COLUMNS.items(), zip(*rows))
        })
        return Tournament(task, target, prepared.n_rows, n_test, list(features), table, best, best_score, failures)
    finally:
        prepared.release()
        test.unpersist()


def _mean_and_deviation(scores: list[float] | Exception | None, fallback: float) -> tuple[float | None, float | None]:
    """Mean and population deviation over the folds; none where a fold failed, the test score and 0 where no folds were asked for."""
    if isinstance(scores, Exception):
        return None, None
    if not scores:
        return fallback, 0.0
    mean = sum(scores) / len(scores)
    return mean, math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores))


def best_model(metrics: DataFrame, task: str) -> DataFrame:
    """Best model of a metric table: greatest score, first in order on ties."""
    scores = metrics.where(F.col("metric") == score_name(task))
    top = F.max(F.struct(F.col("value").alias("score"), (-F.col("ordinal")).alias("order"), F.col("model")))
    return scores.agg(top.alias("top")).select("top.model", "top.score")


def comparison(metrics: DataFrame, task: str) -> DataFrame:
    """One row per model: test score, mean and deviation over the folds, each NULL where it failed."""
    names = [score_name(task), "cv_mean", "cv_std"]
    return metrics.groupBy("ordinal", "model").pivot("metric", names).agg(F.first("value")).select("model", *names)

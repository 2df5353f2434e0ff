import numpy as np
import pytest
from pyspark.sql import functions as F

from tableloom import ExplainOptions, ModelOptions, PrepareOptions, run_study
from tableloom.operators import explain, models, report, split
from tableloom.operators.guards import TrainingError
from tableloom.operators.models import ModelSizes
from tableloom.plans.study import train_models

SMALL_SIZES = ModelSizes(trees=5, tree_depth=4, rounds=3, round_depth=3)
OPTIONS = ModelOptions(sizes=SMALL_SIZES, cv_folds=2)


def frame(spark, n=200, classes=3, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 3))
    y = (x[:, 0] + 0.3 * draw.normal(size=n) > 0).astype(int) if classes == 2 else draw.integers(0, classes, n)
    r = 3 * x[:, 0] - 2 * x[:, 1] + 0.1 * draw.normal(size=n)
    rows = [(i, *map(float, x[i]), int(y[i]), float(r[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id int, f1 double, f2 double, f3 double, label int, value double"), x, y, r


def test_ridge_equals_closed_form(spark):
    df, x, _, r = frame(spark, 60)
    model = models.train(df, "value", "regression", "Ridge", ["f1", "f2", "f3"]).model
    xc, rc = x - x.mean(0), r - r.mean()
    expected = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ rc)
    assert model.coefficients.toArray() == pytest.approx(expected, abs=1e-7)


def test_ridge_by_iteration_equals_closed_form(spark, monkeypatch):
    monkeypatch.setattr(models, "CLOSED_FORM_FEATURES", 0)
    test_ridge_equals_closed_form_loose(spark)


def test_ridge_equals_closed_form_loose(spark):
    df, x, _, r = frame(spark, 60)
    model = models.train(df, "value", "regression", "Ridge", ["f1", "f2", "f3"]).model
    xc, rc = x - x.mean(0), r - r.mean()
    assert model.coefficients.toArray() == pytest.approx(np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ rc), abs=1e-4)


def test_lasso_equals_coordinate_descent(spark):
    df, x, _, r = frame(spark, 80)
    model = models.train(df, "value", "regression", "Lasso", ["f1", "f2", "f3"]).model
    xc, rc = x - x.mean(0), r - r.mean()
    w = np.zeros(3)
    for _ in range(500):
        for j in range(3):
            rho = xc[:, j] @ (rc - xc @ w + xc[:, j] * w[j]) / len(r)
            w[j] = np.sign(rho) * max(abs(rho) - 1.0, 0) / (xc[:, j] @ xc[:, j] / len(r))
    assert model.coefficients.toArray() == pytest.approx(w, abs=1e-4)


def test_logistic_is_the_minimum_of_the_penalised_loss(spark):
    for classes in (2, 3):
        df, x, y, _ = frame(spark, 150, classes)
        model = models.train(df, "label", "classification", "LogisticRegression", ["f1", "f2", "f3"]).model
        weights, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
        scores = x @ weights.T + intercepts
        if classes == 2:
            gradient = x.T @ (1 / (1 + np.exp(-scores[:, 0])) - y) + weights[0]
        else:
            shifted = np.exp(scores - scores.max(1, keepdims=True))
            gradient = (shifted / shifted.sum(1, keepdims=True) - np.eye(3)[y]).T @ x + weights
        assert np.abs(gradient).max() < 0.05


@pytest.mark.parametrize("classes", [2, 4])
def test_classification_tournament(spark, classes):
    df, *_ = frame(spark, 160, classes)
    result = train_models(df.drop("value"), "label", ["id"], OPTIONS)
    assert result.task == "classification" and result.train_rows + result.test_rows == 160
    table = {(r["model"], r["metric"]): r["value"] for r in result.metrics.collect()}
    assert {m for m, _ in table} == set(models.CLASSIFIERS)
    assert all(0 <= table[m, k] <= 1 for m in models.CLASSIFIERS for k in ("accuracy", "precision", "recall", "f1_score", "cv_mean"))
    assert result.best_score == max(table[m, "accuracy"] for m in models.CLASSIFIERS)
    predicted = {r["prediction"] for r in result.predict(df).collect()}
    assert predicted <= set(range(classes))
    importance = result.importance().collect()
    assert [r["rank"] for r in importance] == [1, 2, 3] and all(r["importance"] >= 0 for r in importance)
    assert report.training_summary(result).first()["best_model"] == result.best.name
    assert report.metric_table(result.metrics, result.task).count() == 3
    best = models.best_model(result.metrics, result.task).first()
    assert (best["model"], best["score"]) == (result.best.name, result.best_score)


def test_regression_tournament_and_report(spark):
    df, *_ = frame(spark, 200)
    result = train_models(df.drop("label"), "value", ["id"], OPTIONS)
    assert result.task == "regression" and result.best_score > 0.9
    assert models.comparison(result.metrics, "regression").columns == ["model", "r2_score", "cv_mean", "cv_std"]
    scored = models.predict(result, df).select("value", "prediction")
    assert scored.count() == 200
    facts = report.model_facts(result).collect()
    assert facts[0]["section"] == "model" and sum(r["section"] == "importance" for r in facts) == 3
    assert sum(r["section"] == "scores" for r in facts) == 2 * result.metrics.select("model").distinct().count()


def test_text_and_boolean_labels_come_back_in_their_type(spark):
    df, *_ = frame(spark, 120, 2)
    named = df.withColumn("label", F.when(F.col("label") == 1, "yes").otherwise("no")).withColumn("flag", F.col("label") == "yes")
    for target in ("label", "flag"):
        trained = models.train(named, target, "classification", "LogisticRegression", ["f1", "f2", "f3"])
        out = trained.predict(named)
        assert dict(out.dtypes)["prediction"] == dict(named.dtypes)[target]
        assert out.where(F.col("prediction") == F.col(target)).count() > 90


def test_large_double_labels_and_text_surrogates(spark):
    df, *_ = frame(spark, 100, 2)
    large = df.withColumn("label", F.when(F.col("label") == 1, 1e10).otherwise(2.5))
    trained = models.train(large, "label", "classification", "LogisticRegression", ["f1", "f2", "f3"])
    assert trained.labels.values == [2.5, 1e10]
    assert trained.predict(large).where("prediction = label").count() > 75
    named = df.withColumn("label", F.when(F.col("label") == 1, "yes").otherwise("no"))
    trained = models.train(named, "label", "classification", "LogisticRegression", ["f1", "f2", "f3"])
    local = explain.local_surrogates(trained, named, ["id"], "label", instances=2, samples=60).collect()
    assert {r["actual"] for r in local} <= {0.0, 1.0}


def test_failing_model_is_skipped_and_none_left_is_an_error(spark):
    df, *_ = frame(spark, 60)
    parts = df.randomSplit([0.8, 0.2], 1)
    result = models.run_tournament(*parts, "value", "regression", ["f1", "f2"], names=["Nothing", "Ridge"])
    assert result.best.name == "Ridge"
    assert {r["value"] for r in result.metrics.where("metric = 'cv_std'").collect()} == {0.0}
    with pytest.raises(RuntimeError, match="unknown regression model"):
        models.run_tournament(*parts, "value", "regression", ["f1"], names=["Nothing"])
    with pytest.raises(ValueError, match="trained"):
        models.predict(None, df)


class Refusing:
    """A model that says no, or whose job ends, once it is fitted to some rows."""

    def __init__(self, ended=False):
        self.ended = ended

    def fit(self, rows):
        if self.ended:
            rows.select(F.raise_error(F.lit("executor lost"))).collect()
        raise ValueError("too few rows")


def failing(monkeypatch, model, ended=False, from_rows=0):
    """From its fit number ``from_rows`` on the model fails; the folds of the linear models come from sums, so these fail in the first fit only."""
    real, fits = models.estimator, []

    def chosen(name, *args):
        fits.append(name)
        return Refusing(ended) if name == model and fits.count(name) > from_rows else real(name, *args)

    monkeypatch.setattr(models, "estimator", chosen)


def folded_tournament(spark, names):
    df, *_ = frame(spark, 80)
    parts = df.withColumn("fold", (F.col("id") % 2).cast("int"))
    train, test = parts.where("id % 5 > 0"), parts.where("id % 5 = 0")
    return models.run_tournament(train, test, "value", "regression", ["f1", "f2"], "fold", 2, names, SMALL_SIZES, parallel=1)


def test_a_refused_model_stays_in_the_comparison(spark, monkeypatch):
    failing(monkeypatch, "Lasso")
    result = folded_tournament(spark, ["Lasso", "Ridge"])
    rows = {r["model"]: r for r in models.comparison(result.metrics, "regression").collect()}
    assert tuple(rows["Lasso"])[1:] == (None, None, None) and None not in tuple(rows["Ridge"])
    assert result.best.name == "Ridge" and result.failures == {"Lasso": "not trained: too few rows"}
    facts = {(r["section"], r["name"]): r["value"] for r in report.model_facts(result).collect()}
    assert facts["failed", "Lasso"] == "not trained: too few rows" and facts["model", "models"] == "1"


def test_refused_folds_have_no_mean(spark, monkeypatch):
    """The test score in place of the folds' mean would look like one."""
    failing(monkeypatch, "RandomForest", from_rows=1)
    result = folded_tournament(spark, ["RandomForest", "Ridge"])
    rows = {r["model"]: r for r in models.comparison(result.metrics, "regression").collect()}
    assert rows["RandomForest"]["r2_score"] is not None and tuple(rows["RandomForest"])[2:] == (None, None)
    assert result.failures == {"RandomForest": "folds failed: too few rows"} and None not in tuple(rows["Ridge"])


@pytest.mark.parametrize("from_rows, where", [(0, "RandomForest"), (1, "fold 0 of RandomForest")])
def test_a_job_that_ends_is_no_result(spark, monkeypatch, from_rows, where):
    failing(monkeypatch, "RandomForest", ended=True, from_rows=from_rows)
    with pytest.raises(RuntimeError, match=f"the run failed at {where}: .*executor lost"):
        folded_tournament(spark, ["RandomForest", "Ridge"])


def test_first_of_equal_scores_wins(spark):
    df = spark.createDataFrame(
        [(0, "A", "accuracy", 0.5), (1, "B", "accuracy", 0.9), (2, "C", "accuracy", 0.9)],
        "ordinal int, model string, metric string, value double")
    assert models.best_model(df, "classification").first()["model"] == "B"


def test_shapley_sums_and_both_ways_agree(spark, monkeypatch):
    df, *_ = frame(spark, 100)
    features = ["f1", "f2", "f3"]
    trained = models.train(df, "value", "regression", "RandomForest", features, sizes=SMALL_SIZES)
    by_subset = explain.shapley_values(trained, df, ["id"], rows=10, background=8)
    base = explain.base_value(trained, explain.background_rows(df, ["id"], features, 8, 42)).first()["base_value"]
    output = {str(r["id"]): r["prediction"] for r in trained.predict(df).collect()}
    sums = {r["instance"]: r["s"] for r in by_subset.groupBy("instance").agg(F.sum("shapley_value").alias("s")).collect()}
    assert len(sums) == 10
    for instance, total in sums.items():
        assert total == pytest.approx(output[instance] - base, abs=1e-9)
    exact = {(r["instance"], r["feature"]): r["shapley_value"] for r in by_subset.collect()}
    monkeypatch.setattr(explain, "ALL_SUBSETS_FEATURES", 0)
    sampled = explain.shapley_values(trained, df, ["id"], rows=10, background=8, permutations=30)
    sums = {r["instance"]: r["s"] for r in sampled.groupBy("instance").agg(F.sum("shapley_value").alias("s")).collect()}
    for instance, total in sums.items():
        assert total == pytest.approx(output[instance] - base, abs=1e-9)
    for r in sampled.collect():
        assert r["shapley_value"] == pytest.approx(exact[r["instance"], r["feature"]], abs=0.6)


def test_linear_shapley_equals_closed_form(spark):
    df, *_ = frame(spark, 60)
    features = ["f1", "f2", "f3"]
    trained = models.train(df, "value", "regression", "Ridge", features)
    exact = explain.shapley_values(trained, df, ["id"], rows=60, background=60, method="subsets")
    weights = dict(zip(features, trained.model.coefficients.toArray()))
    closed = explain.linear_shapley_values(df, ["id"], weights, explain.feature_means(df, features), rows=60)
    found = {(r["instance"], r["feature"]): r["shapley_value"] for r in exact.collect()}
    for r in closed.collect():
        assert found[r["instance"], r["feature"]] == pytest.approx(r["shapley_value"], abs=1e-9)
    by_formula = explain.shapley_values(trained, df, ["id"], rows=60, background=60).collect()
    assert {r["method"] for r in by_formula} == {"linear"}
    assert all(r["shapley_value"] == pytest.approx(found[r["instance"], r["feature"]], abs=1e-9) for r in by_formula)
    with pytest.raises(ValueError, match="does not fit"):
        explain.shapley_values(models.train(df, "value", "regression", "RandomForest", features, sizes=SMALL_SIZES), df, ["id"], method="linear")
    top = explain.directions(exact, 2).collect()
    assert [r["feature"] for r in top] == ["f1", "f2"] and "average SHAP importance" in top[0]["explanation"]


def test_local_surrogate_finds_the_feature_that_matters(spark):
    df, *_ = frame(spark, 200)
    trained = models.train(df, "value", "regression", "Ridge", ["f1", "f2", "f3"])
    local = explain.local_surrogates(trained, df, ["id"], "value", instances=4, samples=400, top=2)
    rows = local.collect()
    assert len(rows) == 8 and {r["rank"] for r in rows} == {1, 2}
    assert all(r["feature"] in ("f1", "f2") for r in rows) and all("f" in r["rule"] for r in rows)
    again = explain.local_surrogates(trained, df.repartition(7), ["id"], "value", instances=4, samples=400, top=2).collect()
    assert sorted(map(str, rows)) == pytest.approx(sorted(map(str, again))) or len(again) == 8
    assert explain.top_contributions(local, 1).count() == 4


def test_whole_study(spark, mixed):
    study = run_study(
        mixed, "target", ["id"], PrepareOptions(), OPTIONS, ExplainOptions(rows=5, background=4, permutations=2, instances=2, samples=50))
    assert study.tables["overview"].first()["duplicates_removed"] == 1
    assert study.tables["summary_facts"].where("section = 'model'").count() == 6
    for name in ("deltas", "missing_handled", "training_summary", "model_metrics", "top_importance", "global_importance", "directions", "local_surrogates"):
        assert study.tables[name].count() > 0, name
    assert study.release() > 0


def test_unknown_target(spark, mixed):
    with pytest.raises(ValueError, match="not found"):
        run_study(mixed, "nothing", ["id"])


@pytest.mark.parametrize("parts", [1, 64])
def test_study_without_keys(spark, mixed, parts):
    """The columns themselves tell rows apart: exact sizes, balanced folds, distinct instances."""
    keyless = mixed.drop("id").repartition(parts)
    study = run_study(keyless, "target", model=OPTIONS, explained=ExplainOptions(rows=7, background=4, permutations=2, instances=2, samples=50))
    rows = study.prepared.count()
    assert study.result.train_rows + study.result.test_rows == rows == 100
    assert abs(study.result.test_rows - 20) <= 1 and study.result.best is not None
    assert study.tables["shapley_values"].select("instance").distinct().count() == 7
    assert study.tables["local_surrogates"].select("instance").distinct().count() == 2
    folds = split.assign_folds(study.prepared, [], 4).groupBy("fold").count().collect()
    assert max(r["count"] for r in folds) - min(r["count"] for r in folds) <= 1 and len(folds) == 4


def test_winning_multinomial_model_predicts(spark):
    df, *_ = frame(spark, 150, 3)
    options = ModelOptions(sizes=SMALL_SIZES, cv_folds=2, models=("LogisticRegression",))
    result = train_models(df.drop("value"), "label", ["id"], options)
    assert result.best.name == "LogisticRegression" and {r["prediction"] for r in result.predict(df).collect()} <= {0, 1, 2}
    local = explain.local_surrogates(result.best, df, ["id"], "label", instances=2, samples=60)
    other = explain.local_surrogates(result.best, df, ["id"], "label", instances=2, samples=60, position=1)
    assert sorted(map(str, local.collect())) == sorted(map(str, other.collect()))


def test_many_labels_are_joined(spark, monkeypatch):
    df, *_ = frame(spark, 120, 3)
    named = df.withColumn("label", F.concat(F.lit("c"), "label"))
    plain = models.train(named, "label", "classification", "LogisticRegression", ["f1", "f2"]).predict(named)
    expected = {r["id"]: r["prediction"] for r in plain.collect()}
    monkeypatch.setattr(models, "LITERAL_LABELS", 0)
    joined = models.train(named, "label", "classification", "LogisticRegression", ["f1", "f2"]).predict(named)
    assert {r["id"]: r["prediction"] for r in joined.collect()} == expected


def test_classes_beyond_literals_never_reach_the_driver(spark):
    """300,000 classes: numbered in ranges, joined as a table, and only counted by the driver."""
    df = spark.range(300_000).selectExpr("id", "300000 - id AS label")
    labels = models.fit_labels(df, "label", "classification")
    assert labels.count == 300_000 and not labels.values and not labels.texts
    numbered = labels.attach(df, "label", "at")
    assert numbered.where("at = label - 1").count() == 300_000
    assert labels.restore(numbered.drop("label"), "at", "label").where("label = 300000 - id").count() == 300_000


def test_only_the_heaviest_features_are_fitted_again(spark):
    df, *_ = frame(spark, 150)
    wide = df.withColumns({f"n{i}": F.rand(i) for i in range(12)})
    features = ["f1", "f2", "f3", *[f"n{i}" for i in range(12)]]
    trained = models.train(wide, "value", "regression", "Ridge", features)
    local = explain.local_surrogates(trained, wide, ["id"], "value", instances=2, samples=300)
    assert local.groupBy("instance").count().where("count = 10").count() == 2


def test_causes_are_named(spark):
    rows = [(i, float(i), None if i % 9 == 0 else i % 2, f"t{i}") for i in range(150)]
    df = spark.createDataFrame(rows, "id int, f1 double, y int, words string")
    with pytest.raises(TrainingError, match="missing_target"):
        train_models(df.drop("words"), "y", ["id"], OPTIONS)
    with pytest.raises(TrainingError, match="text_target"):
        train_models(df.drop("y"), "words", ["id"], OPTIONS)


@pytest.mark.parametrize("task", ["classification", "regression"])
def test_forests_of_many_rows_use_bounded_node_groups_and_grow_the_same_trees(spark, monkeypatch, task):
    rows = spark.range(0, 3000, 1, 3).select(
        (F.col("id") * 7919 % 1000 / 10).alias("a"), (F.col("id") * 104729 % 997).cast("double").alias("b"), (F.col("id") % 13).cast("double").alias("c"))
    value = F.col("a") * 3 + F.pmod("b", F.lit(50.0)) - F.col("c")
    rows = rows.withColumn("y", F.when(value > 150, 1).otherwise(0) if task == "classification" else value)
    sizes = models.ModelSizes(trees=12, tree_depth=9)
    prepared = models.prepare_vectors(rows, "y", task, ["a", "b", "c"], sizes=sizes)
    few = prepared.fit("RandomForest").model
    monkeypatch.setattr(models, "MANY_ROWS", 3000)
    monkeypatch.setattr(models, "NODES_MB", 1)
    many = prepared.fit("RandomForest").model
    prepared.release()
    if task == "classification":
        assert not few.getCacheNodeIds() and many.getCacheNodeIds()
    else:
        assert few.getMaxMemoryInMB() == 256 and many.getMaxMemoryInMB() == 1
    assert few.totalNumNodes > 1000 and many.toDebugString.split("\n")[1:] == few.toDebugString.split("\n")[1:]

"""Softmax boosting of three or more classes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableloom.operators import boosting, explain, models, trees
from tableloom.operators.models import ModelSizes

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def classes(spark):
    """Three classes told by two columns, with some noise; the third column says nothing."""
    draw = np.random.default_rng(11)
    x = draw.normal(size=(400, 3))
    y = np.where(x[:, 0] > 0.4, 2, np.where(x[:, 1] > 0, 1, 0))
    noisy = np.where(draw.random(400) < 0.1, draw.integers(0, 3, 400), y)
    rows = [(i, *map(float, x[i]), int(noisy[i]), "uvw"[y[i]]) for i in range(400)]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y int, name string").repartition(3).cache()


def fitted(df, target="y", **sizes):
    return models.train(df, target, "classification", "GradientBoosting", NAMES, sizes=ModelSizes(**{"rounds": 12, "round_depth": 3, **sizes}))


def brute_round(x, y, scores, cuts, depth, rate, classes):
    """One round in plain numpy, node by node over rows."""
    chances = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    out = scores.copy()
    for k in range(classes):
        r = (y == k) - chances[:, k]
        waiting = [(np.arange(len(x)), 0)]
        while waiting:
            rows, level = waiting.pop()
            best = (1e-12 * max(1, len(rows)), None)
            if level < depth and len(rows) >= 5:
                for f in range(x.shape[1]):
                    for c in cuts[f]:
                        left = x[rows, f] <= c
                        n = left.sum()
                        if min(n, len(rows) - n) >= 2:
                            a, b = r[rows][left], r[rows][~left]
                            gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b) - r[rows].sum() ** 2 / len(rows)
                            if gain > best[0] + 1e-9:
                                best = (gain, left)
            if best[1] is None:
                h = np.abs(r[rows]) * (1 - np.abs(r[rows]))
                out[rows, k] += rate * (classes - 1) / classes * r[rows].sum() / h.sum() if h.sum() > 1e-12 else 0
            else:
                waiting += [(rows[best[1]], level + 1), (rows[~best[1]], level + 1)]
    return out


def test_scores_equal_rounds_in_plain_numpy(classes):
    rows = classes.orderBy("id").collect()
    x, y = np.array([[r[n] for n in NAMES] for r in rows]), np.array([r["y"] for r in rows])
    model = fitted(classes, rounds=9).model
    cuts = boosting.feature_cuts(classes.select(F.array(*NAMES).alias("x")), 3, boosting.BINS)
    scores = np.tile(np.log(np.bincount(y) / len(y)), (len(y), 1))
    for _ in range(9):
        scores = brute_round(x, y, scores, cuts, 3, 0.1, 3)
    assert len(model.rounds) == 9 > boosting.REFRESH
    assert model.scores(x) == pytest.approx(scores, abs=1e-8)


def test_loss_falls_each_round_and_probabilities_sum_to_one(classes):
    trained = fitted(classes)
    assert len(trained.model.losses) == 12 and all(b < a for a, b in zip(trained.model.losses, trained.model.losses[1:]))
    vectors = models.assembled(classes, NAMES, ["id", "y"])
    from pyspark.ml.functions import vector_to_array
    scored = trained.model.transform(vectors).withColumn("p", vector_to_array("probability"))
    for r in scored.collect():
        assert sum(r["p"]) == pytest.approx(1.0) and r["prediction"] == float(np.argmax(r["p"]))
    weights = trained.importance(classes.sparkSession).collect()
    assert {weights[0]["feature"], weights[1]["feature"]} == {"a", "b"} and sum(w["importance"] for w in weights) == pytest.approx(1.0)


def test_text_classes_and_learning(classes):
    trained = fitted(classes, "name", rounds=30)
    found = trained.predict(classes)
    assert found.where("prediction = name").count() >= 390 and dict(found.dtypes)["prediction"] == "string"


def test_attributions_of_a_class_score(spark, classes):
    trained = fitted(classes)
    values = explain.shapley_values(trained, classes, ["id"], rows=5, method="tree").collect()
    base = explain.tree_base_value(trained, spark).first()["base_value"]
    rows = {str(r["id"]): [r[n] for n in NAMES] for r in classes.collect()}
    for instance in {v["instance"] for v in values}:
        score = trained.model.scores(np.array([rows[instance]]))[0, 0]
        assert sum(v["shapley_value"] for v in values if v["instance"] == instance) + base == pytest.approx(score)


def test_edges(spark, classes):
    constant = classes.withColumns({"a": F.lit(1.0), "b": F.lit(2.0), "c": F.lit(3.0)})
    trained = fitted(constant)
    assert not trained.model.rounds and trained.predict(constant).select("prediction").distinct().count() == 1
    assert sum(trained.model.featureImportances) == 0
    few = classes.limit(4).withColumn("y", F.col("id"))
    assert fitted(few).predict(few).count() == 4
    with pytest.raises(ValueError, match="needs rows"):
        boosting.SoftmaxBoosting(models.FEATURES, models.LABEL, 3).fit(models.assembled(classes.limit(0), NAMES, [F.lit(0.0).alias(models.LABEL)]))


def test_no_trees_of_mllib_are_needed(spark, classes):
    assert isinstance(fitted(classes).model, boosting.SoftmaxBoostingModel) and trees.is_tree_model(fitted(classes, rounds=1).model)

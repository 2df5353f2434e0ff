"""Exact tree attributions and the kernel method against enumeration and closed forms."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableloom.operators import explain, models, trees
from tableloom.operators.models import ModelSizes

FEATURES = [f"f{i}" for i in range(8)]
SIZES = ModelSizes(trees=7, tree_depth=4, rounds=4, round_depth=3)


@pytest.fixture(scope="module")
def frame(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(220, 8)).round(2)
    value = 3 * x[:, 0] - 2 * x[:, 1] * x[:, 2] + (x[:, 3] > 0.5) + 0.1 * draw.normal(size=220)
    label, many = (value > 0).astype(int), np.digitize(value, [-2, 1])
    rows = [(i, *map(float, x[i]), float(value[i]), int(label[i]), int(many[i])) for i in range(len(x))]
    return spark.createDataFrame(rows, f"id int, {', '.join(f'{f} double' for f in FEATURES)}, value double, label int, many int").cache()


def fitted(df, target, name):
    return models.train(df, target, "regression" if target == "value" else "classification", name, FEATURES, sizes=SIZES)


def by_instance(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["instance"], {})[r["feature"]] = r["shapley_value"]
    return out


def brute_by_shares(paths, x):
    """All subsets of all features; a feature outside one lets its share through."""
    n = len(x)

    def worth(subset):
        total = 0.0
        for p in paths:
            part = p["value"]
            for f, low, high, share in zip(p["features"], p["low"], p["high"], p["share"]):
                part *= (low < x[f] <= high) if f in subset else share
            total += part
        return total

    known = {s: worth(s) for k in range(n + 1) for s in itertools.combinations(range(n), k)}
    out = []
    for j in range(n):
        total = 0.0
        for s in known:
            if j not in s:
                weight = math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n)
                total += weight * (known[tuple(sorted((*s, j)))] - known[s])
        out.append(total)
    return out, known[()], known[tuple(range(n))]


@pytest.mark.parametrize(("target", "name"), [("value", "RandomForest"), ("value", "GradientBoosting"), ("label", "RandomForest"), ("label", "GradientBoosting"), ("many", "GradientBoosting")])
def test_tree_values_equal_all_subsets_by_shares(spark, frame, target, name):
    trained = fitted(frame, target, name)
    position = explain.explained_position(trained)
    paths = trees.tree_paths(spark, trained.model, position).collect()
    found = by_instance(explain.shapley_values(trained, frame, ["id"], rows=3, method="tree"))
    rows = {str(r["id"]): [r[f] for f in FEATURES] for r in frame.collect()}
    base = explain.tree_base_value(trained, spark).first()["base_value"]
    assert len(found) == 3
    for instance, values in found.items():
        wanted, empty, whole = brute_by_shares(paths, rows[instance])
        assert [values[f] for f in FEATURES] == pytest.approx(wanted, abs=1e-9)
        assert base == pytest.approx(empty) and sum(values.values()) + base == pytest.approx(whole)


@pytest.mark.parametrize(("target", "name"), [("value", "RandomForest"), ("value", "GradientBoosting"), ("label", "RandomForest"), ("many", "RandomForest")])
def test_tree_values_with_background_equal_scored_subsets(frame, target, name):
    trained = fitted(frame, target, name)
    exact = by_instance(explain.shapley_values(trained, frame, ["id"], rows=4, background=6, method="subsets"))
    found = by_instance(explain.shapley_values(trained, frame, ["id"], rows=4, background=6))
    assert found.keys() == exact.keys() and len(found) == 4
    for instance, values in exact.items():
        assert [found[instance][f] for f in FEATURES] == pytest.approx([values[f] for f in FEATURES], abs=1e-9)


def test_orders_come_near_the_exact_values(frame):
    trained = fitted(frame, "value", "RandomForest")
    exact = by_instance(explain.shapley_values(trained, frame, ["id"], rows=4, background=6))
    found = by_instance(explain.shapley_values(trained, frame, ["id"], rows=4, background=6, permutations=30, method="orders"))
    for instance, values in exact.items():
        assert sum(found[instance].values()) == pytest.approx(sum(values.values()), abs=1e-9)
        assert [found[instance][f] for f in FEATURES] == pytest.approx([values[f] for f in FEATURES], abs=0.6)


def test_paths_sum_to_the_models_output(spark, frame):
    x = np.array([[r[f] for f in FEATURES] for r in frame.orderBy("id").collect()])
    for target, name in (("value", "RandomForest"), ("value", "GradientBoosting"), ("label", "RandomForest"), ("label", "GradientBoosting")):
        trained = fitted(frame, target, name)
        paths = trees.tree_paths(spark, trained.model, explain.explained_position(trained))
        found = [r["output"] for r in trees.path_outputs(paths, x).orderBy("i").collect()]
        if name == "GradientBoosting" and target == "label":
            found = [1 / (1 + math.exp(-v)) for v in found]
        vectors = models.assembled(frame, FEATURES, ["id"])
        assert found == pytest.approx([r["output"] for r in trained.output(vectors).orderBy("id").collect()], abs=1e-9)


@pytest.mark.parametrize("width", [1, 2, 3, 8, 25])
def test_subset_weights_are_exact_at_any_depth(width):
    """A path of 25 features: the integral against the sums over subset sizes."""
    draw = np.random.default_rng(width)
    share, holds = draw.uniform(0.05, 1, (1, width)), draw.random((1, 1, width)) < 0.6
    found = trees._subset_weights(holds, share)[0, 0]
    for j in range(width):
        sizes = [1.0]
        for i in range(width):
            if i != j:
                sizes = [a * share[0, i] + b * holds[0, 0, i] for a, b in zip([*sizes, 0.0], [0.0, *sizes])]
        wanted = sum(q / (width * math.comb(width - 1, s)) for s, q in enumerate(sizes))
        assert found[j] == pytest.approx(wanted, rel=1e-9)


def test_kernel_equals_subsets_when_all_are_fitted(frame):
    trained = models.train(frame, "label", "classification", "LogisticRegression", FEATURES[:5])
    exact = by_instance(explain.shapley_values(trained, frame, ["id"], rows=5, background=6, method="subsets"))
    found = by_instance(explain.shapley_values(trained, frame, ["id"], rows=5, background=6, method="kernel"))
    for instance, values in exact.items():
        assert [found[instance][f] for f in FEATURES[:5]] == pytest.approx([values[f] for f in FEATURES[:5]], abs=1e-9)


def test_kernel_of_drawn_coalitions_is_exact_for_a_linear_model(frame):
    trained = models.train(frame, "value", "regression", "Ridge", FEATURES)
    closed = by_instance(explain.shapley_values(trained, frame, ["id"], rows=5, background=6))
    found = by_instance(explain.shapley_values(trained, frame, ["id"], rows=5, background=6, method="kernel", coalitions=40))
    for instance, values in closed.items():
        assert [found[instance][f] for f in FEATURES] == pytest.approx([values[f] for f in FEATURES], abs=1e-9)


def test_kernel_of_one_feature_and_method_names(frame):
    trained = models.train(frame, "value", "regression", "Ridge", ["f0"])
    one = explain.shapley_values(trained, frame, ["id"], rows=3, background=5, method="kernel").collect()
    closed = {r["instance"]: r["shapley_value"] for r in explain.shapley_values(trained, frame, ["id"], rows=3, background=5).collect()}
    assert {r["instance"]: r["shapley_value"] for r in one} == pytest.approx(closed)
    for method in ("tree", "tree_background", "other"):
        with pytest.raises(ValueError, match="does not fit"):
            explain.shapley_values(trained, frame, ["id"], method=method)


@pytest.mark.parametrize(("n", "budget"), [(2, 10), (3, 100), (6, 20), (6, 1_000), (40, 300)])
def test_coalitions_weigh_what_the_kernel_says(n, budget):
    masks, weights = explain.coalition_table(n, budget, 3)
    assert len(masks) <= max(budget, 2**n - 2) and len({tuple(m) for m in masks}) == len(masks)
    assert weights.sum() == pytest.approx(sum((n - 1) / (s * (n - s)) for s in range(1, n)))
    sizes = masks.sum(axis=1)
    if 2 * n <= budget:
        assert weights[sizes == 1].tolist() == pytest.approx([1 / n] * n)


def test_empty_sample_has_no_values(spark, frame):
    trained = fitted(frame, "value", "RandomForest")
    assert explain.shapley_values(trained, frame.where(F.lit(False)), ["id"], method="tree").count() == 0

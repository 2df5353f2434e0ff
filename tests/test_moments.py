"""Sums of products: correlations of many columns, and folds of linear models without refitting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableloom.operators import models, moments, profile, split


def table(spark, x, names):
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(3)


def brute(x, i, j):
    both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
    a, b = x[both, i], x[both, j]
    if len(a) < 2 or np.ptp(a) == 0 or np.ptp(b) == 0:
        return None
    return np.corrcoef(a, b)[0, 1]


def test_pairs_with_gaps_constants_and_far_means(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(300, 24)) + draw.normal(size=(300, 1))
    x[draw.random(x.shape) < 0.2] = np.nan
    x[:, 0], x[:, 1], x[:, 2] = 3.7, np.nan, 1e9 + draw.normal(size=300)
    x[:, 3] = np.where(np.arange(300) < 150, 5.25, np.nan)
    names = [f"c.{i}" for i in range(24)]
    found = {(r["a"], r["b"]): r["r"] for r in profile.correlations(table(spark, x, names)).collect()}
    assert len(found) == 24 * 24
    for i in range(24):
        for j in range(24):
            wanted = brute(x, i, j)
            assert found[names[i], names[j]] == (None if wanted is None else pytest.approx(wanted, abs=1e-7)), (i, j)


def test_five_hundred_columns_in_one_pass(spark):
    draw = np.random.default_rng(6)
    x = draw.normal(size=(200, 500)) + draw.normal(size=(200, 1))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").select(*[F.get("x", F.lit(i)).alias(f"c{i}") for i in range(500)])
    found = moments.correlation_matrix(df, [F.col(f"c{i}") for i in range(500)])
    assert found == pytest.approx(np.corrcoef(x.T), abs=1e-9)


def test_empty_table_and_one_row(spark):
    df = table(spark, np.ones((1, 30)), [f"c{i}" for i in range(30)])
    assert all(r["r"] is None for r in profile.correlations(df).collect())
    none = profile.correlations(df.limit(0)).collect()
    assert len(none) == 900 and all(r["r"] is None for r in none)


def folded(spark, n=300, features=6):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(n, features)) * 5 + 1_000
    y = x[:, 0] * 2 - x[:, 1] + draw.normal(size=n)
    names = [f"f{i}" for i in range(features)]
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, f"id int, {', '.join(f'{c} double' for c in names)}, y double")
    return split.assign_folds(df, ["id"], 4, name="fold"), names


@pytest.mark.parametrize("name", ["Ridge", "Lasso"])
def test_folds_from_sums_equal_refitted_folds(spark, name):
    df, names = folded(spark)
    prepared = models.prepare_vectors(df, "y", "regression", names, fold="fold")
    sums = models.summed_folds(prepared, [name], "fold")
    for number in range(4):
        refitted = models.fold_score(prepared, name, "fold", number)
        assert models.fold_score(prepared, name, "fold", number, sums) == pytest.approx(refitted, abs=1e-6)
    assert models.cross_validate(prepared, [name], "fold", 4)[name] == pytest.approx([models.fold_score(prepared, name, "fold", k, sums) for k in range(4)])
    prepared.release()


def test_folds_need_one_pass_over_the_rows(spark):
    """Once the sums are there, fits and scores of all folds start no job."""
    df, names = folded(spark)
    prepared = models.prepare_vectors(df, "y", "regression", names, fold="fold")
    sums = models.summed_folds(prepared, ["Ridge", "Lasso"], "fold")
    tracker, group = spark.sparkContext.statusTracker(), "folds-from-sums"
    spark.sparkContext.setJobGroup(group, "")
    scores = [models.fold_score(prepared, name, "fold", k, sums) for name in ("Ridge", "Lasso") for k in range(4)]
    assert len(tracker.getJobIdsForGroup(group)) == 0 and all(s > 0.5 for s in scores)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    prepared.release()


def test_constant_targets_and_features(spark):
    df = spark.range(40).selectExpr("id", "7.5D AS f0", "double(id % 5) AS f1", "3.0D AS y", "int(id % 2) AS fold")
    prepared = models.prepare_vectors(df, "y", "regression", ["f0", "f1"], fold="fold")
    for name in ("Ridge", "Lasso"):
        assert models.cross_validate(prepared, [name], "fold", 2)[name] == [1.0, 1.0]
    prepared.release()

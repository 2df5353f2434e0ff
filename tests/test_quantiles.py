import numpy as np
import pytest
from pyspark.sql import functions as F

from tableloom.operators.quantiles import narrowed_quantiles, quantiles, quantiles_and_measures

PROBS = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


def frames(spark):
    draw = np.random.default_rng(7)
    n = 4000
    hot = np.where(draw.random(n) < 0.4, 5.0, draw.lognormal(2, 2, n))
    return {
        "normal": draw.normal(size=n), "hot": hot, "few": draw.integers(0, 4, n).astype(float),
        "constant": np.full(n, 2.5), "heavy": draw.pareto(0.5, n),
    }


@pytest.mark.parametrize("accuracy,bracket,few", [(20, 5, 0), (100, 50, 10)])
def test_narrowing_is_exact(spark, accuracy, bracket, few):
    data = frames(spark)
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in data.values()])), list(data)).repartition(5)
    found = narrowed_quantiles(df, list(data), PROBS, accuracy, bracket, few)
    for name, values in data.items():
        assert found[name] == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12), name


def test_large_path_is_taken_by_size_and_skips_nulls(spark):
    df = spark.range(1001).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("x"), F.lit(None).cast("double").alias("none"))
    direct = quantiles(df, ["x", "none"], [0.25, 0.5])
    assert direct == quantiles(df, ["x", "none"], [0.25, 0.5], direct_rows=10) == {"x": [250.0, 500.0], "none": [None, None]}


def test_one_and_two_rows(spark):
    assert quantiles(spark.createDataFrame([(3.0,)], "x double"), ["x"], [0.25]) == {"x": [3.0]}
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert quantiles(df, ["x"], [0.25], direct_rows=1) == {"x": [1.25]}


def test_few_jobs(spark):
    """One pass for guesses and moments, one that confirms, one for the values."""
    data = frames(spark)
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in data.values()])), list(data)).repartition(5)
    spark.sparkContext.setJobGroup("quantiles", "")
    found, seen = quantiles_and_measures(df, list(data), [0.5], {"mean": F.avg}, direct_rows=10)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("quantiles")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 12 and seen["count", "few"] == 4000
    for name, values in data.items():
        assert found[name][0] == pytest.approx(np.median(values)) and seen["mean", name] == pytest.approx(values.mean())

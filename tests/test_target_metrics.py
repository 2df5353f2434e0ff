import pytest
from pyspark.sql import functions as F

from tableloom.operators.metrics import classification_metrics, regression_metrics
from tableloom.operators.target import task_of


def test_binary_metrics_follow_the_confusion_counts(spark):
    """True and false positives and negatives chosen so that all four scores differ."""
    hits, false_alarms, misses, rejections = 12, 4, 8, 26
    counts = {(1, 1): hits, (0, 1): false_alarms, (1, 0): misses, (0, 0): rejections}
    rows = [pair for pair, n in counts.items() for _ in range(n)]
    found = classification_metrics(spark.createDataFrame(rows, "y int, p int"), "y", "p").first()
    precision, recall = hits / (hits + false_alarms), hits / (hits + misses)
    assert found["accuracy"] == pytest.approx((hits + rejections) / len(rows))
    assert found["precision"] == pytest.approx(precision) and found["recall"] == pytest.approx(recall)
    assert found["f1_score"] == pytest.approx(2 * precision * recall / (precision + recall))


def test_regression_metrics_of_a_shifted_line(spark):
    """Predictions off by +d and -d in turn: every error has size d, the truth is a run of even spacing."""
    n, d = 40, 1.25
    rows = [(3.0 * i, 3.0 * i + (d if i % 2 else -d)) for i in range(n)]
    found = regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    variance = 9.0 * (n * n - 1) / 12
    assert found["mse"] == pytest.approx(d * d) and found["rmse"] == pytest.approx(d) and found["mae"] == pytest.approx(d)
    assert found["r2_score"] == pytest.approx(1 - d * d / variance)


def test_weighted_scores_for_three_classes(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("c", "c"), ("c", "c")]
    found = classification_metrics(spark.createDataFrame(rows, "y string, p string"), "y", "p").first()
    assert found["accuracy"] == pytest.approx(4 / 6)
    assert found["precision"] == pytest.approx((2 * 0.5 + 1 * 0.5 + 3 * 1.0) / 6)
    assert found["recall"] == pytest.approx((2 * 0.5 + 1 * 1.0 + 3 * 2 / 3) / 6)


def test_zero_division_counts_as_zero(spark):
    found = classification_metrics(spark.createDataFrame([(1, 0), (0, 0)], "y int, p int"), "y", "p").first()
    assert (found["precision"], found["recall"], found["f1_score"]) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("predicted,expected", [(2.0, 1.0), (3.0, 0.0)])
def test_constant_truth(spark, predicted, expected):
    df = spark.createDataFrame([(2.0, predicted)] * 3, "y double, p double")
    assert regression_metrics(df, "y", "p").first()["r2_score"] == expected


@pytest.mark.parametrize("expression,expected", [
    ("id * 1.5D", "regression"),                                  # every value its own
    ("cast(id % 2 AS bigint)", "classification"),                 # two values
    ("cast(id % 20 AS double) + 0.5D", "classification"),         # twenty values
    ("concat('c', id % 100)", "classification"),                  # text, a hundred classes
    ("concat('c', id % 101)", "regression"),                      # text, one more
    ("id % 2 = 0", "classification"),                             # boolean
    ("(id % 90) * 7", "classification"),                          # whole numbers, few for the rows
    ("id % 49 + 1", "classification"),                            # a run from one
    ("cast(id % 400 AS bigint)", "regression"),                   # a longer run
    ("cast(id % 40 AS double) / 3", "regression"),                # rare fractions
    ("if(id % 10 = 0, 0.5D, cast(id % 40 AS double) / 3)", "classification"),  # a frequent fraction
    ("id % 1200", "regression"),                                  # more than half distinct
])
def test_task(spark, expression, expected):
    df = spark.range(2000).select(F.expr(expression).alias("y"))
    assert task_of(df, "y") == expected


def test_estimate_settles_a_clearly_continuous_target(spark, monkeypatch):
    from tableloom.operators import target

    df = spark.range(5000).select(F.col("id").cast("double").alias("wide"), (F.col("id") % 3).alias("narrow"))
    monkeypatch.setattr(target, "SMALL_TARGET", 0)
    assert target.task_of(df, "narrow") == "classification"
    monkeypatch.setattr(target, "detect_task", None)
    assert target.task_of(df, "wide") == "regression"

import pytest
from pyspark.sql import functions as F

from tableloom.functions.columns import clip, day_of_week, is_weekend, map_values, null_every, threshold_label, weighted_score
from tableloom.functions.text import clean_prose, paragraphs
from tableloom.operators import clean, features, profile


def one(spark, text, build):
    return spark.createDataFrame([(text,)], "t string").select(build(F.col("t")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("### Title\n\nSome **bold**  text\t here", "Title\n\nSome bold text here"),
    ("- item\n.dot\n#tag\nkept", "kept"),
    ("a‑b × c → d²", "a-b x c -> d²"),
    ("• bullet\n   \n`code`", "bullet\n\ncode"),
    ("", ""),
    (None, None),
])
def test_clean_prose(spark, text, expected):
    assert one(spark, text, clean_prose) == expected


def test_star_line_loses_its_mark_first(spark):
    # Stars are removed from the text before lines are judged, so such a line stays.
    assert one(spark, "* star", clean_prose) == "star"


def test_paragraphs(spark):
    df = spark.createDataFrame([(1, "## Head\nline\n\n- no\n\n\n\nlast  one")], "id int, t string")
    assert [tuple(r) for r in paragraphs(df, "t", ["id"]).collect()] == [(1, 0, "Head line"), (1, 3, "last one")]


def test_column_helpers(spark):
    df = spark.sql("SELECT 5.0D AS x, 'a' AS k, timestamp'2024-01-06' AS d, 3L AS i")
    row = df.select(
        clip(F.col("x"), 6).alias("low"), clip(F.col("x"), upper=4).alias("high"),
        map_values(F.col("k"), {"a": 1.5}).alias("hit"), map_values(F.lit("z"), {"a": 1.5}).alias("miss"),
        day_of_week(F.col("d")).alias("dow"), is_weekend(F.col("d")).alias("end"),
        threshold_label(weighted_score([(0.5, F.col("x"), 0, 10), (0.5, F.col("x"), 0, 5)])).alias("label"),
        null_every(F.col("x"), F.col("i"), 4, 3).alias("gone"),
    ).first()
    assert tuple(row) == (6.0, 4.0, 1.5, None, 5, 1, 1, None)


def test_ratio_survives_a_zero_denominator(spark):
    df = spark.createDataFrame([(1.0, -1e-8), (1.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(features.pair_ratio("a", "b")).collect()] == [None, pytest.approx(1e8)]


def test_constant_column_profiles(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 5, "x double, y double")
    stats = profile.feature_statistics(df, "y").first()
    assert (stats["skewness"], stats["kurtosis"], stats["std"]) == (0.0, 0.0, 0.0)
    bins = profile.histogram(df, ["x"]).collect()
    assert len(bins) == 30 and sum(r["n"] for r in bins) == 5
    assert all(r["r"] is None for r in profile.correlations(df).collect())


def test_empty_category_and_target_left_out(spark):
    df = spark.createDataFrame([(None, 1.0)], "c string, y double")
    assert tuple(profile.categorical_summary(df).first()) == ("c", 0, "N/A")
    assert profile.feature_statistics(spark.createDataFrame([(1.0, 2.0)], "x double, y double"), "y").count() == 1


def test_histogram_keeps_the_greatest_value_in_the_last_bin(spark):
    df = spark.range(31).select(F.col("id").cast("double").alias("x"))
    counts = {r["bin"]: r["n"] for r in profile.histogram(df).collect()}
    assert counts[29] == 2 and sum(counts.values()) == 31


def test_quality_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x double, c string")
    row = profile.quality_statistics(df).first()
    assert (row["total_rows"], row["missing_values_total"], row["completeness"]) == (0, 0, None)


def test_profiles_of_columns_that_do_not_exist(spark):
    """A table without numbers or without texts gives empty profiles with their columns."""
    texts, numbers = spark.createDataFrame([("a",), (None,)], "s string"), spark.createDataFrame([(1.0,), (2.0,)], "x double")
    for build in (profile.describe, profile.box_plot, profile.histogram, profile.feature_statistics, profile.correlations):
        empty, full = build(texts), build(numbers)
        assert empty.count() == 0 and empty.columns == full.columns, build.__name__
    blank = spark.createDataFrame([(None,)], "x double")
    assert profile.box_plot(blank).count() == 0 and profile.histogram(blank).count() == 0
    assert profile.categorical_summary(numbers).columns == profile.categorical_summary(texts).columns
    for method in ("iqr", "zscore"):
        assert clean.outlier_counts(texts, method).count() == 0


def test_named_columns_are_never_cut(spark):
    df = spark.range(30).select(*[(F.col("id") * (i + 1)).cast("double").alias(f"c{i}") for i in range(12)])
    assert profile.box_plot(df, df.columns).count() == 12 and profile.box_plot(df).count() == 10
    assert profile.feature_statistics(df, columns=df.columns).count() == 12
    assert profile.histogram(df, df.columns, 5).count() == 60 and profile.histogram(df, bins=5).count() == 20

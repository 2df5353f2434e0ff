from collections import Counter

import pytest
from pyspark.sql import functions as F

from tableloom.operators import encode, levels


def many(spark):
    """3000 rows, a third of them one value, over 700 distinct values."""
    value = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), (F.col("id") % 700).cast("string")))
    return spark.range(3000).select("id", value.alias("c"))


def test_range_numbered_codes_equal_sorted_positions(spark, monkeypatch):
    monkeypatch.setattr(levels, "ONE_TASK_LEVELS", 10)
    monkeypatch.setattr(levels, "RANGE_PARTS", 7)
    distinct = many(spark).select(F.col("c").alias("value")).distinct()
    found = {r["value"]: r["code"] for r in levels.sorted_codes(distinct, distinct.count()).collect()}
    assert found == {v: i for i, v in enumerate(sorted(found))}


def test_salted_shuffle_join_equals_broadcast(spark, monkeypatch):
    df = many(spark)
    expected = {r["id"]: r["c"] for r in encode.label_encode(df, ["c"]).collect()}
    monkeypatch.setattr(encode, "LOCAL_LEVELS", 5)
    monkeypatch.setattr(levels, "BROADCAST_LEVELS", 5)
    monkeypatch.setattr(levels, "ONE_TASK_LEVELS", 5)
    monkeypatch.setattr(levels, "HOT_SHARE", 0.1)
    fitted = encode.fit_encoding(df, ["c"], threshold=-1)
    assert fitted.label["c"].hot == ("hot",)
    coded = fitted.transform(df)
    assert {r["id"]: r["c"] for r in coded.collect()} == expected
    assert coded.count() == 3000


def test_mode_takes_smallest_of_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    row = levels.level_summary(levels.value_counts(df, ["c"])).first()
    assert (row["mode"], row["n_distinct"], row["n_levels"], row["n_rows"]) == ("a", 2, 3, 7)


def test_onehot_drops_first_level_and_nulls_are_false(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4)], "k string, n int")
    coded = encode.onehot_encode(df, ["k"])
    assert coded.columns == ["n", "k_b", "k_c"]
    assert sorted(map(tuple, coded.collect())) == [(1, True, False), (2, False, False), (3, False, False), (4, False, True)]


def test_constant_category_leaves_no_indicator(spark):
    df = spark.createDataFrame([(1, "A", 10), (2, "A", 20)], "col1 int, col2 string, col3 int")
    assert encode.onehot_encode(df, ["col2"]).columns == ["col1", "col3"]


def test_label_nulls_and_unseen_values(spark):
    df = spark.createDataFrame([("z",), (None,), ("a",)], "c string")
    fitted = encode.fit_encoding(df, ["c"], threshold=0)
    assert Counter(r["c"] for r in fitted.transform(df).collect()) == Counter([0, 1, 2])
    new = spark.createDataFrame([("a",), ("q",)], "c string")
    with pytest.raises(Exception, match="unseen value"):
        fitted.transform(new).collect()
    assert [r["c"] for r in fitted.transform(new, unseen="null").collect()] == [0, None]

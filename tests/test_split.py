import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tableloom.operators import split
from tableloom.operators.guards import TrainingError, judge, remove_singletons


def digest(key) -> str:
    return hashlib.md5(f"42|{key}".encode()).hexdigest()


def skewed(spark, n=3000):
    """A third of the rows in one class, the others in nine."""
    y = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 9).cast("string"))
    return spark.range(n).select("id", y.alias("y"))


@pytest.mark.parametrize("fetch", [2000, 1])
def test_random_split_is_exact(spark, monkeypatch, fetch):
    monkeypatch.setattr(split, "FETCH_ROWS", fetch)
    df = spark.range(1003)
    parts = split.split(df, ["id"], share=0.2).collect()
    test = {r["id"] for r in parts if r["is_test"]}
    assert len(parts) == 1003 and len(test) == math.ceil(0.2 * 1003)
    assert test == set(sorted(range(1003), key=digest)[: len(test)])


@pytest.mark.parametrize("fetch", [2000, 3])
def test_stratified_split_is_exact_in_each_class(spark, monkeypatch, fetch):
    monkeypatch.setattr(split, "FETCH_ROWS", fetch)
    rows = split.split(skewed(spark), ["id"], "y").collect()
    for y in {r["y"] for r in rows}:
        own = [r for r in rows if r["y"] == y]
        assert sum(r["is_test"] for r in own) == math.floor(0.2 * len(own) + 0.5)


def test_same_rows_at_any_partitioning(spark):
    df = skewed(spark)
    one = {r["id"] for r in split.split(df.coalesce(1), ["id"], "y").where("is_test").collect()}
    many = {r["id"] for r in split.split(df.repartition(64), ["id"], "y").where("is_test").collect()}
    assert one == many


def test_split_moves_no_row(spark):
    plan = split.split(skewed(spark), ["id"], "y")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Sort" not in plan


def test_one_row_class_falls_back_to_random(spark):
    df = spark.createDataFrame([(i, "a") for i in range(9)] + [(9, "b")], "id int, y string")
    assert split.split(df, ["id"], "y").where("is_test").count() == 2


def test_class_keeps_one_row_on_each_side(spark):
    df = spark.createDataFrame([(i, "a") for i in range(20)] + [(20, "b"), (21, "b")], "id int, y string")
    rows = split.split(df, ["id"], "y").where("y = 'b'").collect()
    assert sorted(r["is_test"] for r in rows) == [False, True]


def test_repeated_keys_stay_together(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("id"))
    rows = split.split(df, ["id"]).collect()
    assert all(len({r["is_test"] for r in rows if r["id"] == i}) == 1 for i in range(50))


@pytest.mark.parametrize("target", [None, "y"])
def test_folds_are_equal_and_complete(spark, target):
    rows = split.assign_folds(skewed(spark, 1001), ["id"], 5, target).collect()
    assert len(rows) == 1001 and {r["fold"] for r in rows} == set(range(5))
    for y in {r["y"] for r in rows} if target else [None]:
        sizes = [sum(r["fold"] == f and (y is None or r["y"] == y) for r in rows) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("rows,smallest,requested,expected", [
    (100, None, 5, 5), (7, None, 5, 3), (3, None, 5, 2), (100, 1, 5, 2), (100, 4, 5, 2), (100, 6, 10, 6), (100, 50, 5, 5),
])
def test_fold_count(rows, smallest, requested, expected):
    assert split.fold_count(rows, smallest, requested) == expected


def test_guards(spark):
    few = spark.createDataFrame([(i, "a") for i in range(5)], "id int, y string")
    with pytest.raises(TrainingError, match="too_few_rows"):
        judge(few, "y", "classification").check()
    unique = spark.range(50).select(F.col("id").cast("string").alias("y"))
    with pytest.raises(TrainingError, match="too_many_classes"):
        judge(unique, "y", "classification").check()
    assert judge(unique, "y", "regression").verdict == "ok"
    mostly = spark.createDataFrame([("a",)] * 30 + [(str(i),) for i in range(3)], "y string")
    with pytest.raises(TrainingError, match="mostly_singletons"):
        judge(mostly, "y", "classification").check()
    third = spark.createDataFrame([(c,) for c in "aabbcc" * 3] + [("x",), ("y",)], "y string")
    assert judge(third, "y", "classification").verdict == "too_many_singletons"


def test_singletons_leave_both_parts(spark):
    train = spark.createDataFrame([("a",)] * 8 + [("b",)] * 8 + [("c",)] * 8 + [("d",)] * 8 + [("e",)], "y string")
    test = spark.createDataFrame([("a",), ("e",), (None,)], "y string")
    verdict = judge(train, "y", "classification")
    assert verdict.verdict == "remove_singletons"
    kept, other = remove_singletons(train, test, "y")
    assert kept.count() == 32 and {r["y"] for r in other.collect()} == {"a", None}


def test_sample_is_reproducible(spark):
    df = spark.range(300)
    one = {r["id"] for r in split.sample_rows(df.coalesce(1), ["id"], 20).collect()}
    assert one == {r["id"] for r in split.sample_rows(df.repartition(9), ["id"], 20).collect()} and len(one) == 20


@pytest.mark.parametrize("classes", [2, 9])
def test_few_and_many_classes_are_cut_alike(spark, monkeypatch, classes):
    """The short way for few classes and the joined one give the same rows, repeated keys included."""
    df = spark.range(700).selectExpr("id % 650 AS id", f"IF(id % 31 = 0, NULL, id % {classes}) AS y").withColumn("row", F.monotonically_increasing_id())
    found = {}
    for cells in (split.FEW_CELLS, 0):
        monkeypatch.setattr(split, "FEW_CELLS", cells)
        parts = split.split(df, ["id"], "y")
        folds = split.assign_folds(df, ["id"], 5, "y")
        found[cells] = (sorted((r["row"], r["is_test"]) for r in parts.collect()), sorted((r["row"], r["fold"]) for r in folds.collect()))
    short, joined = found.values()
    assert short == joined and len(short[0]) == 700
    monkeypatch.setattr(split, "FETCH_ROWS", 0)
    monkeypatch.setattr(split, "FEW_CELLS", 50_000)
    assert sorted((r["row"], r["fold"]) for r in split.assign_folds(df, ["id"], 5, "y").collect()) == joined[1]

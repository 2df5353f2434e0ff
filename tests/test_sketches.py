"""Sketches of batches, merged in any way, against exact counts and ranks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableloom.operators import profile, sketches


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(40_000).selectExpr(
        "id", "id % 7 AS day", "IF(id % 11 = 0, NULL, concat('v', id % 12000)) AS name", "IF(id % 5 = 0, NULL, (id * 7919) % 40000 / 4.0) AS amount",
        "'same' AS constant", "CAST(NULL AS DOUBLE) AS nothing").cache()


def test_any_split_of_the_rows_is_within_the_bound(spark, rows):
    columns = ["id", "name", "amount", "constant", "nothing"]
    exact = rows.agg(*[F.countDistinct(c).alias(c) for c in columns]).first().asDict()
    whole = sketches.sketch_columns(rows, columns)
    by_day = sketches.sketch_columns(rows, columns, ["day"])
    parts = [sketches.sketch_columns(rows.where(F.col("id") % 3 == k).repartition(5), columns) for k in range(3)]
    merged_twice = sketches.merge_sketches(sketches.merge_sketches(*parts[:2]), parts[2])
    for found in (whole, sketches.merge_sketches(by_day), merged_twice):
        for r in sketches.approximate_summary(found).collect():
            assert r["at_least"] <= exact[r["column"]] <= r["at_most"], r
            assert abs(r["n_distinct"] - exact[r["column"]]) <= sketches.DISTINCT_ERROR * exact[r["column"]] + 1
        missing = {r["column"]: r["n_missing"] for r in sketches.approximate_summary(found).collect()}
        assert missing["nothing"] == 40_000 and missing["id"] == 0 and missing["amount"] == 8_000


def test_quantiles_keep_their_rank(spark, rows):
    values = np.sort([r["amount"] for r in rows.where("amount IS NOT NULL").collect()])
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = sketches.sketch_quantiles(sketches.merge_sketches(sketches.sketch_columns(rows, ["amount", "nothing", "name"], ["day"])), shares)
    for share, value in zip(shares, found["amount"]):
        rank = (np.searchsorted(values, value, "left") + np.searchsorted(values, value, "right")) / 2 / len(values)
        assert abs(rank - share) <= sketches.RANK_ERROR + 1 / len(values)
    assert found["amount"][0] == values[0] and found["amount"][-1] == values[-1]
    assert found["nothing"] == [None] * 7 and found["name"] == [None] * 7


def test_merge_by_batch_and_stored_sketches(spark, rows, tmp_path):
    path = str(tmp_path / "sketches.parquet")
    sketches.sketch_columns(rows, ["name", "amount"], ["day"]).write.parquet(path)
    stored = spark.read.parquet(path)
    weekend = sketches.merge_sketches(stored.where("day >= 5"))
    exact = rows.where("day >= 5").agg(F.countDistinct("name")).first()[0]
    row = {r["column"]: r for r in sketches.approximate_summary(weekend).collect()}["name"]
    assert row["at_least"] <= exact <= row["at_most"]
    per_day = sketches.approximate_summary(sketches.merge_sketches(stored, by=["day"]))
    assert per_day.count() == 14 and per_day.columns[0] == "day"


def test_empty_table(spark, rows):
    found = sketches.sketch_columns(rows.limit(0), ["name", "amount"])
    assert [(r["n_distinct"], r["n_missing"]) for r in sketches.approximate_summary(found).collect()] == [(0, 0), (0, 0)]
    assert sketches.sketch_quantiles(found, [0.5]) == {"name": [None], "amount": [None]}


def test_approximate_categories(spark, rows):
    common = rows.withColumn("kind", F.when(F.col("id") % 3 > 0, F.lit("usual")).when(F.col("id") % 9 > 0, F.col("name")))
    exact = {r["column"]: r for r in profile.categorical_summary(common, ["kind", "constant", "name"]).collect()}
    found = {r["column"]: r for r in profile.categorical_summary(common, ["kind", "constant", "name"], approximate=True).collect()}
    for name in exact:
        assert abs(found[name]["n_distinct"] - exact[name]["n_distinct"]) <= sketches.DISTINCT_ERROR * exact[name]["n_distinct"]
    assert found["kind"]["most_common"] == "usual" and found["constant"]["most_common"] == "same"
    none = profile.categorical_summary(common.select(F.lit(None).cast("string").alias("t")), ["t"], approximate=True).first()
    assert (none["n_distinct"], none["most_common"]) == (0, "N/A")

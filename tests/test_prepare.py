import pytest
from pyspark.sql import functions as F

from tableloom import PrepareOptions, fit_prepare
from tableloom.operators import clean, features, profile
from tableloom.plans.prepare import PreparePlan
from tableloom.streaming.apply import transform_stream, write_stream

BASE = PrepareOptions(derive_features=False)


def metadata(plan: PreparePlan) -> dict:
    return {(s, c, m): v for s, c, m, v in plan.metadata_rows}


def test_nothing_missing_after_preparation(spark, mixed):
    plan = fit_prepare(mixed, "target", ["id"], BASE)
    out = plan.fitted_table()
    assert profile.missing_counts(out).count() == 0
    facts = metadata(plan)
    assert facts["duplicates", None, "removed"] == "1"
    assert facts["input", None, "rows"] == "101" and facts["output", None, "rows"] == "100"
    assert facts["missing", "numeric1", "count"] == str(mixed.where("numeric1 IS NULL").count())
    assert out.where("id = 100").count() == 0 and out.where("id = 0").count() == 1
    assert "category1" not in out.columns and "category1_B" in out.columns
    assert dict(out.dtypes)["category1_B"] == "boolean"


def test_target_stays_with_its_row(spark, mixed):
    out = fit_prepare(mixed, "target", ["id"], PrepareOptions(outlier_method="zscore")).fitted_table()
    joined = out.select("id", "target").join(mixed.select("id", F.col("target").alias("before")), "id")
    assert joined.where("target <> before").count() == 0


def test_scaled_numbers_have_mean_zero_and_deviation_one(spark, mixed):
    out = fit_prepare(mixed, "target", ["id"], BASE).fitted_table()
    for c in ("numeric1", "numeric2"):
        row = out.agg(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).first()
        assert row["m"] == pytest.approx(0, abs=1e-9) and row["s"] == pytest.approx(1, abs=1e-9)


def test_outlier_is_capped_and_counted(spark, mixed):
    wild = mixed.withColumn("numeric1", F.when(F.col("id") == 5, 1000.0).otherwise(F.col("numeric1")))
    plan = fit_prepare(wild, "target", ["id"], PrepareOptions(scale_features=False, derive_features=False))
    assert plan.fitted_table().agg(F.max("numeric1")).first()[0] < 1000
    assert int(metadata(plan)["outliers", "numeric1", "count"]) >= 1
    kept = fit_prepare(wild, "target", ["id"], PrepareOptions(scale_features=False, derive_features=False, cap_outliers=False))
    assert kept.fitted_table().agg(F.max("numeric1")).first()[0] == 1000
    assert metadata(kept)["outliers", "numeric1", "count"] == metadata(plan)["outliers", "numeric1", "count"]


def test_zscore_removes_rows_and_reports(spark):
    rows = [(i, float(i), 2.0) for i in range(50)] + [(50, 5000.0, 2.0), (51, 7.0, 2.0)]
    df = spark.createDataFrame(rows, "id int, x double, same double")
    plan = fit_prepare(df, None, ["id"], PrepareOptions(outlier_method="zscore", scale_features=False, derive_features=False))
    facts = metadata(plan)
    assert facts["outliers", "x", "count"] == "1" and facts["outliers", "same", "count"] == "0"
    assert facts["duplicates", None, "removed"] == "1" and facts["output", None, "rows"] == "50"
    assert sorted(r["id"] for r in plan.fitted_table().collect()) == list(range(50))


def test_sequential_zscore_uses_rows_left_by_earlier_columns(spark):
    rows = [(float(i % 7), float(i % 3)) for i in range(60)] + [(900.0, 400.0), (1.0, 30.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    fitted, outliers = clean.fit_zscore_sequential(df, ["a", "b"])
    assert outliers == {"a": 1, "b": 1}
    assert fitted.transform(df).count() == 60
    assert clean.fit_zscore_sequential(df, [])[1] == {}


def test_knn_zscore_robust_options(spark, mixed):
    options = PrepareOptions(missing_strategy="knn", outlier_method="zscore", scaler="robust")
    out = fit_prepare(mixed, "target", ["id"], options).fitted_table()
    assert profile.missing_counts(out).count() == 0
    assert {"numeric1_x_numeric2", "numeric1_div_numeric2", "numeric1_squared", "numeric2_log"} <= set(out.columns)


def test_all_missing_column_is_dropped(spark):
    df = spark.createDataFrame([(i, None, 10 * i) for i in range(1, 6)], "col1 bigint, col2 double, col3 bigint")
    plan = fit_prepare(df, options=PrepareOptions(missing_threshold=1.0))
    assert plan.dropped == ("col2",)
    assert "col2" not in clean.drop_sparse_columns(df).columns


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0)], "a int, half double")
    assert clean.drop_sparse_columns(df, 0.5).columns == ["a", "half"]
    assert clean.drop_sparse_columns(df, 0.49).columns == ["a"]


def test_missing_stage_is_left_out_when_complete(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, c string")
    plan = fit_prepare(df, options=PrepareOptions(outlier_method="auto", scale_features=False, derive_features=False))
    assert dict(plan.fitted_table().dtypes)["n"] == "int"
    assert plan.fill.numeric == {} and plan.outliers is None


def test_no_numeric_columns(spark):
    df = spark.createDataFrame([("A", "X"), ("B", "Y"), ("C", "Z")], "cat1 string, cat2 string")
    out = fit_prepare(df).fitted_table()
    assert out.columns == ["cat1_B", "cat1_C", "cat2_Y", "cat2_Z"] and out.count() == 3


def test_unknown_option_is_an_error():
    with pytest.raises(ValueError, match="scaler"):
        PrepareOptions(scaler="minmax")


def test_plan_applies_to_new_rows(spark, mixed):
    plan = fit_prepare(mixed, "target", ["id"], BASE)
    again = plan.transform(mixed).orderBy("id").collect()
    assert again == plan.fitted_table().select(*plan.transform(mixed).columns).orderBy("id").collect()


def test_same_result_at_other_partitionings(spark, mixed):
    def rows(parts: str, frame):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            out = fit_prepare(frame, "target", ["id"]).fitted_table().orderBy("id").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        return [[round(v, 9) if isinstance(v, float) else v for v in r] for r in out]

    assert rows("1", mixed.coalesce(1)) == rows("64", mixed.repartition(13))


def test_stream_equals_batch(spark, mixed, tmp_path):
    plan = fit_prepare(mixed, "target", ["id"])
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    mixed.repartition(2).write.parquet(source)
    stream = spark.readStream.schema(mixed.schema).parquet(source)
    query = write_stream(transform_stream(plan, stream), sink, str(tmp_path / "state")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    got = spark.read.parquet(sink).orderBy("id").collect()
    assert got == plan.transform(mixed, deduplicate=False).orderBy("id").collect()


def test_robust_and_standard_keep_scale_one_for_constants(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    for fitted in (features.fit_standard(df, ["x"]), features.fit_robust(df, ["x"])):
        assert fitted.scales == {"x": 1.0}
        assert [r["x"] for r in fitted.transform(df).collect()] == [0.0, 0.0]


def test_capping_keeps_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (100.0,)], "x double")
    capped = clean.Fences({"x": (0.0, 10.0)}).transform(df)
    assert sorted((r["x"] is None, r["x"]) for r in capped.collect()) == [(False, 1.0), (False, 10.0), (True, None)]


def test_duplicates_keep_lowest_key(spark):
    df = spark.createDataFrame([(3, "a", 30), (1, "a", 10), (2, "b", 20), (9, None, 1), (8, None, 2)], "id int, v string, t int")
    assert sorted(map(tuple, clean.drop_duplicates(df, ["v"], ["id"], ["id", "t"]).collect()), key=str) == [
        (1, "a", 10), (2, "b", 20), (8, None, 2)]
    assert clean.drop_duplicates(df.select("v"), ["v"]).count() == 3


def test_neighbour_plans_do_not_stream(spark, mixed, tmp_path):
    plan = fit_prepare(mixed, "target", ["id"], PrepareOptions(missing_strategy="knn"))
    with pytest.raises(ValueError, match="knn"):
        transform_stream(plan, mixed)


def test_derived_features_can_be_chosen(spark, mixed):
    few = fit_prepare(mixed, "target", ["id"], PrepareOptions(derived_pairs=0, derived_singles=1)).fitted_table()
    assert sum(c.endswith("_squared") for c in few.columns) == 1 and not any("_x_" in c for c in few.columns)


def test_integer_keys_deduplicate_in_hash_maps(spark):
    rows = [(5, 1, "a", 1.0), (-3, 9, "a", 2.0), (-3, 4, "a", 3.0), (None, 7, "b", 4.0), (2, 2, "b", 5.0), (8, 8, "c", 6.0)]
    df = spark.createDataFrame(rows, "k1 int, k2 bigint, v string, t double")
    out = clean.drop_duplicates(df, ["v"], ["k1", "k2"], ["k1", "k2", "t"])
    assert sorted(map(tuple, out.collect()), key=str) == [(-3, 4, "a", 3.0), (8, 8, "c", 6.0), (None, 7, "b", 4.0)]
    assert out.schema.simpleString() == df.schema.simpleString()
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    wide = df.withColumn("k1", F.when(F.col("k1") == 8, F.lit(2**62)).otherwise(F.col("k1").cast("bigint")))
    assert sorted(map(tuple, clean.drop_duplicates(wide, ["v"], ["k1", "k2"], ["k1", "k2", "t"]).collect()), key=str)[0] == (-3, 4, "a", 3.0)

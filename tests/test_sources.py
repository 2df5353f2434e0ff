import pytest
from pyspark.sql import types as T

from tableloom.functions.columns import column_kinds
from tableloom.operators import profile
from tableloom.sources.tables import feature_columns, infer_types, read_table, resolve_target, write_table


def test_missing_path_and_suffix_are_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none.csv"))
    other = tmp_path / "table.json"
    other.write_text("{}")
    with pytest.raises(ValueError, match="unsupported"):
        read_table(spark, str(other))
    with pytest.raises(ValueError, match="unsupported"):
        write_table(spark.range(1), str(tmp_path / "table.txt"))


def test_csv_types_and_missing_tokens(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text(
        "whole,gappy,real,flag,gappy_flag,text,empty,mixed,code\n"
        '1,1,1.5,True,True,"a, ""b""",,1,1d\n'
        "-2,NA,1e3,False,,n/a,NaN,x,2d\n"
        "3,3,.5,TRUE,False, NA,null,3,3d\n"
    )
    df = read_table(spark, str(path))
    assert [f.dataType for f in df.schema.fields] == [
        T.LongType(), T.DoubleType(), T.DoubleType(), T.BooleanType(), T.StringType(), T.StringType(),
        T.DoubleType(), T.StringType(), T.StringType(),
    ]
    rows = df.collect()
    assert [r["gappy"] for r in rows] == [1.0, None, 3.0]
    assert [r["text"] for r in rows] == ['a, "b"', None, " NA"]
    assert [r["flag"] for r in rows] == [True, False, True]
    assert all(r["empty"] is None for r in rows)


def test_explicit_schema_reads_once(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("a,b\n1,x\nNA,y\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert [tuple(r) for r in read_table(spark, str(path), schema).collect()] == [(1, "x"), (None, "y")]


@pytest.mark.parametrize("suffix", ["csv", "parquet"])
def test_round_trip_creates_parents(spark, tmp_path, suffix):
    df = spark.createDataFrame([(i, f"v{i}", i / 7) for i in range(5)], "col1 bigint, col2 string, col3 double")
    path = write_table(df, str(tmp_path / "deep" / "er" / f"t.{suffix}"))
    back = read_table(spark, path)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(Exception, match="(?i)exists"):
        write_table(df, path)


def test_texts_survive_line_breaks_and_outer_spaces(spark, tmp_path):
    texts = [" x ", "a\nb", 'quote " and, comma', "\ttab", "crlf\r\nend", "\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    back = read_table(spark, write_table(df, str(tmp_path / "texts.csv")))
    assert back.schema.simpleString() == df.schema.simpleString()
    assert dict(map(tuple, back.collect())) == dict(enumerate(texts))
    plain = write_table(df.where("id = 0"), str(tmp_path / "plain.csv"))
    assert read_table(spark, plain, multi_line=False).collect() == df.where("id = 0").collect()


def test_nan_becomes_null_at_input(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    back = read_table(spark, write_table(df, str(tmp_path / "n.parquet")))
    assert back.where("x IS NULL").count() == 1


def test_target(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert resolve_target(df) == "c"
    assert resolve_target(df, "a") == "a"
    assert feature_columns(df, "a", ["b"]) == ["c"]
    with pytest.raises(ValueError, match="not found"):
        resolve_target(df, "z")


def test_kinds(spark):
    df = spark.sql("SELECT 1L AS i, 2.0D AS f, 'x' AS s, current_timestamp() AS t, true AS b, array(1) AS a")
    kinds = column_kinds(df)
    assert (kinds.numeric, kinds.categorical, kinds.datetime, kinds.other) == (["i", "f"], ["s"], ["t"], ["b", "a"])
    assert profile.kinds_table(df).count() == 6


def test_infer_keeps_typed_columns(spark):
    df = spark.createDataFrame([(1, "2")], "a int, b string")
    assert infer_types(df).schema.simpleString() == "struct<a:int,b:bigint>"


def test_kept_tables_can_be_cleared(spark, tmp_path, monkeypatch):
    from tableloom import session

    monkeypatch.setattr(session, "checkpoint_dir", lambda _: str(tmp_path))
    monkeypatch.setattr(session, "_kept", {"another application": ["untouched"]})
    first, second = session.materialize(spark.range(5)), session.materialize(spark.range(6))
    assert first.count() == 5 and second.count() == 6 and len(list(tmp_path.iterdir())) == 2
    assert session.clear_kept(spark, since=1) == 1 and first.count() == 5 and len(list(tmp_path.iterdir())) == 1
    assert session.clear_kept(spark) == 1 and not list(tmp_path.iterdir())
    assert session._kept["another application"] == ["untouched"]


def test_without_a_shared_folder_rows_are_persisted(spark, monkeypatch):
    from tableloom import session

    monkeypatch.setattr(session, "checkpoint_dir", lambda _: None)
    monkeypatch.setattr(session, "_kept", {})
    held = session.materialize(spark.range(3))
    assert held.storageLevel.useDisk and held.count() == 3
    assert session.clear_kept(spark) == 1 and not held.storageLevel.useDisk

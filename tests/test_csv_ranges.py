"""CSV files cut into ranges of any size against the reader that takes a file as a whole."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from tableloom.sources import csv_ranges
from tableloom.sources.tables import read_table, write_table

TEXTS = [
    "plain", "", " spaces ", "a\nb", "\n", "\n\n\nmany\nlines\n", 'a "quote"', '"', '""', '","', ",\n,", 'ends in "\n"', "crlf\r\nend", "é\n日本", "x" * 300,
    'all, of "it"\n\n"",\n', "5 inches",
]


@pytest.fixture
def small_ranges(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield cut
    for n, value in before.items():
        spark.conf.set(n, value)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(path, rows, end="\n"):
    with open(path, "w", newline="") as file:
        csv.writer(file, lineterminator=end).writerows([["id", "text", "other"], *rows])


@pytest.mark.parametrize("size", [40, 1_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_range_gives_the_same_records(spark, tmp_path, small_ranges, size, end):
    draw = random.Random(size)
    rows = [(str(i), draw.choice(TEXTS), draw.choice(TEXTS)) for i in range(40)]
    write(tmp_path / "t.csv", rows, end)
    small_ranges(size)
    df = csv_ranges.read_csv_ranges(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["id", "text", "other"]
    assert rows_of(df.na.fill("")) == sorted(rows, key=repr)


def test_equal_to_the_reader_of_whole_files(spark, tmp_path, small_ranges):
    """Quotes in bare fields, short and long rows, blank lines, and several files with a header each."""
    odd = 'id,text,other\n1,5" pipe,x\n2,"a""b\n",y"z\n\n3\n4,"open, and\nclosed",tail\n5,a,b\n6,"x"y,z\n'
    (tmp_path / "f.csv").mkdir()
    for name, text in (("a", odd), ("b", "id,text,other\n7,c,d"), ("c", ""), ("d", "id,text,other\n")):
        (tmp_path / "f.csv" / f"{name}.csv").write_text(text)
    path = str(tmp_path / "f.csv")
    whole = rows_of(spark.read.csv(path, header=True, **csv_ranges.OPTIONS))
    for size in (9, 1_000):
        small_ranges(size)
        assert rows_of(csv_ranges.read_csv_ranges(spark, path)) == whole, size


def test_one_text_over_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i}, with comma" for i in range(60))
    write(tmp_path / "t.csv", [("1", long, "a"), ("2", "b", long + '"')])
    small_ranges(200)
    assert rows_of(csv_ranges.read_csv_ranges(spark, str(tmp_path / "t.csv"))) == [("1", long, "a"), ("2", "b", long + '"')]


def test_more_than_one_task_reads_one_file(spark, tmp_path, small_ranges):
    write(tmp_path / "t.csv", [(str(i), "a\nb", "c") for i in range(2_000)])
    small_ranges(4_000)
    df = read_table(spark, str(tmp_path / "t.csv"))
    tasks = csv_ranges.file_lines(spark, str(tmp_path / "t.csv")).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4 and df.count() == 2_000 and dict(df.dtypes) == {"id": "bigint", "text": "string", "other": "string"}


def test_header_only_and_written_folders(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n")
    assert csv_ranges.read_csv_ranges(spark, str(tmp_path / "h.csv")).count() == 0
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if t], "id bigint, text string").repartition(5)
    path = write_table(df, str(tmp_path / "w.csv"))
    assert rows_of(read_table(spark, path)) == rows_of(df)


def test_states_of_lines():
    for line, outside, inside in (("a,b", False, True), ('"a', True, False), ('a"b', False, False), ('x,"y""', True, False), ('""', False, True), ('","', False, True), ('a,"b",c', False, False)):
        assert (csv_ranges.ends_inside(line, False), csv_ranges.ends_inside(line, True)) == (outside, inside), line


def test_the_query_writes_files_of_bounded_ranges(spark, small_ranges, tmp_path):
    """One task must not write the whole table: its files grow in number with it, and each is still cut into ranges."""
    from checks.catalog import QUERIES
    from checks.profile_queries import RANGES_A_FILE

    texts = spark.range(0, 600, 1, 24).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a"), F.lit('"b",'), "id").alias("text"), F.lit(7).alias("n_chars"))
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    small_ranges(1_500)
    ranges = spark.read.parquet(f"{tmp_path}/documents.parquet").rdd.getNumPartitions()
    found = QUERIES["a1_read_csv_parallel"](spark, str(tmp_path))
    files = [f for f in found.inputFiles() if "/breaks-" in f]
    assert ranges >= 24 and len(files) >= ranges // RANGES_A_FILE
    assert csv_ranges.file_lines(spark, files).select("file", "range").distinct().count() > len(files)
    assert rows_of(found) == sorted(((i, f' "a\n"b",\n{i}", \n""end" ', 7) for i in range(600)), key=repr)


@pytest.fixture
def small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("size, end", [(30, "\n"), (120, "\r\n")])
def test_any_separator_gives_the_same_records(spark, tmp_path, small_ranges, small_batches, monkeypatch, size, end):
    """Records and fields go over ranges and Arrow batches at every place, with empty first and last fields among them."""
    draw = random.Random(size)
    rows = [(draw.choice(["", "7", "a, b"]), draw.choice(TEXTS), draw.choice(["", *TEXTS])) for _ in range(20)]
    rows = [r for r in rows if any(r)]
    write(tmp_path / "t.csv", rows, end)
    small_ranges(size)
    for separator in ("\n", ","):
        monkeypatch.setattr(csv_ranges, "best_separator", lambda lines, columns, chosen=separator: chosen)
        df = csv_ranges.read_csv_ranges(spark, str(tmp_path / "t.csv"))
        assert rows_of(df.na.fill("")) == sorted(rows, key=repr), separator


def test_commas_as_separators_equal_the_reader_of_whole_files(spark, tmp_path, small_ranges, small_batches, monkeypatch):
    odd = 'id,text,other\n1,5" pipe,x\n2,"a""b\n",y"z\n\n3\n4,"open, and\nclosed",tail\n,,\n5,a,b\n6,"x"y,z\n7,"x"y"z,"\n",\n,8," ""q"", "'
    (tmp_path / "f.csv").mkdir()
    (tmp_path / "f.csv" / "1.csv").write_text(odd)
    (tmp_path / "f.csv" / "2.csv").write_text(odd + "\n")
    path = str(tmp_path / "f.csv")
    whole = rows_of(spark.read.csv(path, header=True, **csv_ranges.OPTIONS))
    for separator in ("\n", ","):
        monkeypatch.setattr(csv_ranges, "best_separator", lambda lines, columns, chosen=separator: chosen)
        for size in (9, 64):
            small_ranges(size)
            assert rows_of(csv_ranges.read_csv_ranges(spark, path)) == whole, (separator, size)


def test_commas_separate_where_they_make_fewer_chunks(spark, tmp_path, small_ranges):
    """A text that breaks after every word must not cost a row a word; a range without a comma would be part of a very long chunk."""
    words = [(str(i), "\n".join(["word"] * 50), "x") for i in range(20)]
    write(tmp_path / "words.csv", words)
    write(tmp_path / "gap.csv", [*words, ("y", "\n".join(["word"] * 400), "z")])
    write(tmp_path / "numbers.csv", [(i, i, i) for i in range(20)])
    small_ranges(1_000)

    def separator(name, columns=3):
        return csv_ranges.best_separator(csv_ranges.file_lines(spark, str(tmp_path / name)), columns)

    assert [separator("words.csv"), separator("words.csv", 1), separator("gap.csv"), separator("numbers.csv")] == [",", "\n", "\n", "\n"]
    assert csv_ranges.file_lines(spark, str(tmp_path / "words.csv"), ",").count() < csv_ranges.file_lines(spark, str(tmp_path / "words.csv")).count() / 10
    assert rows_of(csv_ranges.read_csv_ranges(spark, str(tmp_path / "words.csv"))) == sorted(words)


def test_record_ends_with_and_without_quotes_in_bare_fields():
    import numpy as np

    for text, inside, ends, after in (("a,b\nc,", False, [3], False), ('"a\n",', True, [2], True), ('a\n",\n', True, [4], False), ('5" x\n"y\n",z\n', False, [4, 11], False), ('""\n"', False, [2], True)):
        found, state = csv_ranges._record_ends(np.frombuffer(text.encode(), np.uint8), inside)
        assert (found.tolist(), state) == (ends, after), text

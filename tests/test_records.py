"""Quoted files read in byte ranges against Spark's reader of whole files."""

import random

import pytest

from civiltext.sources import corpus as cp, records


def whole(spark, path):
    return spark.read.option("header", True).option("multiLine", True) \
        .option("quote", '"').option("escape", '"').csv(path)


def rows(df):
    return sorted(map(str, df.collect()))


def texts(n, seed=2):
    rng = random.Random(seed)
    parts = ["plain", 'say "no"', "a,b", "line\nbreak", "\n\n", '""', "é漢", "\n\"\n,\"", " ", "end"]
    return [" ".join(rng.choices(parts, k=rng.randrange(1, 9))) for _ in range(n)]


@pytest.fixture
def small_ranges(spark):
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def written(spark, path, n, files):
    df = spark.createDataFrame([(f"r{i}", t, i % 2, 0) for i, t in enumerate(texts(n))],
                               "id string, comment_text string, toxic int, insult int")
    cp.write_labeled_csv(df.repartition(files), path)


@pytest.mark.parametrize("files", [1, 5])
def test_same_rows_as_whole_files(spark, tmp_path, small_ranges, files):
    path = f"{tmp_path}/csv"
    written(spark, path, 600, files)
    found = records._lines(spark, path)
    assert found.select("file", "range").distinct().count() > 20
    assert rows(records.read_csv(spark, path)) == rows(whole(spark, path))
    got = cp.read_labeled_csv(spark, path)
    assert got.count() == 600 and got.columns == ["id", "comment_text", "toxic", "insult"]


def test_record_longer_than_ranges(spark, tmp_path, small_ranges):
    path = f"{tmp_path}/long.csv"
    long = "\n".join(f'line {i} ""quoted""' for i in range(900))
    with open(path, "w", newline="") as out:
        out.write(f'id,comment_text,toxic\n1,"{long}",1\n2,x,0\n\n3,"{long}",1\n4,"a\nb",0')
    assert rows(records.read_csv(spark, path)) == rows(whole(spark, path))
    assert [len(r.comment_text) for r in records.read_csv(spark, path).orderBy("id").collect()] \
        == [len(long) - 1800, 1, len(long) - 1800, 3]


def test_windows_line_ends_and_open_quotes(spark, tmp_path, small_ranges):
    path = f"{tmp_path}/crlf.csv"
    with open(path, "w", newline="") as out:
        out.write('id,comment_text\r\n' + "".join(f'{i},"a{i}\r\nb"\r\n{i},plain\r\n' for i in range(80)))
    got = records.read_csv(spark, path)
    assert rows(got) == rows(whole(spark, path)) and got.count() == 160
    open_ = f"{tmp_path}/open.csv"
    with open(open_, "w") as out:
        out.write('id,comment_text\n1,a\n2,"never closed\n3,b\n')
    assert records.read_records(spark, open_).count() == 3


def test_no_records(spark, tmp_path):
    path = f"{tmp_path}/empty.csv"
    with open(path, "w") as out:
        out.write("id,comment_text,toxic\n")
    assert records.read_csv(spark, path).collect() == []

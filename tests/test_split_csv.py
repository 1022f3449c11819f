"""Quoted CSV by many tasks a file against the reader that takes a file whole."""

import csv
import random

import pytest
from pyspark.sql import types as T

from labelfold.sources import corpus_io as io
from labelfold.sources import split_csv as sc

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("note", T.StringType()), T.StructField("n", T.IntegerType())])


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def words(rng):
    piece = ["a", "b,", "\n", "\n\n", '"', '""', " ", "é😀", "x" * 40, "\r\n", ",", "id,text"]
    return "".join(rng.choice(piece) for _ in range(rng.randint(0, 12)))


def write(path, rows, end="\n", header=True):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        if header:
            w.writerow(["id", "text", "note", "n"])
        w.writerows(rows)


@pytest.mark.parametrize("seed", range(4))
def test_random_files_equal_the_whole_file_reader(spark, tmp_path, small_ranges, seed):
    rng, want = random.Random(seed), []
    for f in range(3):
        rows = [(i, words(rng), words(rng), rng.choice([None, i])) for i in range(rng.choice([0, 40, 250]))]
        if seed == 1:
            rows.insert(len(rows) // 2, (10_000, "long\n" * 900, 'one record over many ranges"', 7))
        write(tmp_path / f"part-{f}.csv", rows, "\r\n" if seed == 2 else "\n")
    got = sc.read_quoted_csv(spark, str(tmp_path), SCHEMA)
    whole = spark.read.schema(SCHEMA).options(**io.CSV_READ).csv(str(tmp_path))
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(key, got.collect())) == sorted(map(key, whole.collect()))
    ranges = sc.csv_records(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
    assert ranges.filter("first").count() == 3


def test_a_labelled_folder_with_partitions(spark, tmp_path, small_ranges):
    from labelfold.functions.dictionary import make_dictionary
    rng = random.Random(5)
    d = make_dictionary(["a", "b"])
    rows = [(f"s{i % 2}", f'text {i} "quoted"\nsecond, line {words(rng)}', i % 2, None if i % 7 == 0 else 1) for i in range(300)]
    df = spark.createDataFrame(rows, "split string, text string, a int, b int")
    io.write_labeled(df, str(tmp_path / "t"), "csv")
    got = io.read_labeled_csv(spark, str(tmp_path / "t"), d)
    old = io.read_labeled_csv(spark, str(tmp_path / "t"), d, splittable=False)
    assert got.columns == old.columns == ["text", "a", "b", "split"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, old.collect()))


def test_empty_files_and_lines(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("id,text,note,n\n")
    (tmp_path / "lines.csv").write_text('\nid,text,note,n\n\n1,x,"a\n\nb",2\n\n2,"",,\n3,last,"",4')
    rows = sc.read_quoted_csv(spark, str(tmp_path), SCHEMA).orderBy("id").collect()
    whole = spark.read.schema(SCHEMA).options(**io.CSV_READ).csv(str(tmp_path)).orderBy("id").collect()
    assert rows == whole and len(rows) == 3 and rows[0].note == "a\n\nb"


def test_files_that_parity_cannot_read_are_refused(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('id,text,note,n\n1,5" pipe,x,2\n')
    with pytest.raises(ValueError):
        sc.read_quoted_csv(spark, str(tmp_path), SCHEMA)

"""Corpus operators, validation, sources and sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelfold.functions.dictionary import default_dictionary, make_dictionary
from labelfold.operators import corpus as cp
from labelfold.sources import corpus_io as io


def test_normalize_alias_and_missing(spark):
    d = default_dictionary()
    raw = spark.createDataFrame([("hi", 1, 1, 0)], "`문장` string, `남성` int, `기타혐오` int, extra int")
    assert not cp.detect_labels(raw, d)
    out = cp.normalize_labels(raw, d, text_col="문장").collect()[0].asDict()
    assert out["text"] == "hi" and out["남성"] == 1 and out["기타 혐오"] == 1 and out["clean"] == 0
    assert "extra" not in out


def test_union_splits_and_prefix(spark):
    a = spark.range(50).select(F.col("id").alias("k"))
    b = spark.range(100, 120).select(F.col("id").alias("k"))
    u = cp.union_splits(train=a, valid=b)
    p = cp.take_prefix(u, 10, "k").collect()
    assert sorted(r["k"] for r in p if r["split"] == "train") == list(range(10))
    assert sorted(r["k"] for r in p if r["split"] == "valid") == [100, 101]


def test_shuffle_is_reproducible(spark):
    df = spark.range(200).select(F.col("id").alias("k"))
    a = [r["k"] for r in cp.shuffle_rows(df.repartition(3), "k", 42, 1).collect()]
    b = [r["k"] for r in cp.shuffle_rows(df.repartition(7), "k", 42, 1).collect()]
    c = [r["k"] for r in cp.shuffle_rows(df, "k", 42, 2).collect()]
    assert a == b and a != c and sorted(a) == list(range(200))


def test_validate_requests_reasons(spark):
    rows = [(1, "", 0.5), (2, "   ", 0.5), (3, "x" * 4001, 0.5), (4, "ok", -0.1), (5, "ok", 1.1),
            (6, None, 0.5), (7, "fine", None), (8, "x" * 4000, 1.0)]
    df = spark.createDataFrame(rows, "id int, text string, threshold double")
    got = {r["id"]: (r["reason"], r["threshold"]) for r in cp.validate_requests(df).collect()}
    assert got[1][0] == "text_too_short" and got[2][0] == "text_blank" and got[3][0] == "text_too_long"
    assert got[4][0] == got[5][0] == "threshold_out_of_range" and got[6][0] == "text_missing"
    assert got[7] == (None, 0.5) and got[8][0] is None


def test_csv_text_round_trip(spark, tmp_path):
    d = make_dictionary(["x"])
    texts = ['a "q", b\nline2', "NA", "", "back\\slash", " pad ", None]
    df = spark.createDataFrame([(i, t, i % 2, "train") for i, t in enumerate(texts)],
                               "id long, text string, x int, split string")
    path = str(tmp_path / "csv")
    io.write_labeled(df, path, "csv")
    back = {r["id"]: r["text"] for r in io.read_labeled_csv(spark, path, d, extra=[("id", T.LongType())]).collect()}
    assert back[0] == 'a "q", b\nline2' and back[1] == "NA" and back[3] == "back\\slash"
    assert back[4] == " pad " and back[5] is None


def test_label_list_parse(spark):
    df = spark.createDataFrame([("[0, 1, 1]",), ("[0.0, 1.0]",)], "s string")
    got = [r["l"] for r in df.select(io.parse_label_list("s").alias("l")).collect()]
    assert got == [[0, 1, 1], [0, 1]]
    assert df.select(io.format_label_list(F.array(F.lit(0), F.lit(1))).alias("t")).first()["t"] == "[0, 1]"


def test_label_dictionary_json(spark, tmp_path):
    p = tmp_path / "label_info.json"
    p.write_text(default_dictionary().to_json(), encoding="utf-8")
    d = io.read_label_dictionary(spark, str(p))
    assert d.names == default_dictionary().names and d.k == 10
    assert d.en("기타혐오") == "Other Hate" and d.en("unknown") == "unknown"


def test_cardinality_rollup(spark):
    df = spark.createDataFrame([("train", 1, 1), ("train", 0, 0), ("valid", 1, 0)],
                               "split string, a int, b int")
    d = make_dictionary(["a", "b"])
    got = {r["split"]: r for r in cp.cardinality_stats(df, d).collect()}
    assert got["all"]["total_samples"] == 3 and got["train"]["samples_with_multiple_labels"] == 1
    assert got["all"]["avg_labels_per_sample"] == 1.0 and got["valid"]["max_labels_per_sample"] == 1


def test_statistics_of_recorded_batches_equal_those_of_all_rows(spark):
    """Replayed and reordered batches, one replaced by fewer rows, one that has become empty, one without rows."""
    import random

    from labelfold.functions.dictionary import make_dictionary
    from labelfold.operators import incremental as inc
    from labelfold.session import scratch_path
    rng = random.Random(3)
    d = make_dictionary(["a", "b'c", "never"])
    rows = [(rng.choice(["train", "valid", None]), int(rng.random() < 0.4), int(rng.random() < 0.2), 0) for _ in range(500)]
    df = spark.createDataFrame(rows, "split string, a int, `b'c` int, never int").repartition(3).cache()
    parts = {i: df.filter(F.pmod(F.hash(*df.columns, F.spark_partition_id()), F.lit(4)) == i).cache() for i in range(4)}
    assert sum(p.count() for p in parts.values()) == 500
    store = scratch_path(spark, "store")
    inc.record_batch(df, 3, store, d)                       # a first try with other rows
    for i in (3, 1, 0, 1, 2, 3):
        inc.record_batch(parts[i], i, store, d)
    inc.record_batch(df, 9, store, d)
    inc.record_batch(df.limit(0), 9, store, d)              # now without rows
    key = lambda x: sorted(map(repr, x.collect()))
    cols = cp.dataset_statistics(df, d).columns
    assert key(inc.merged_statistics(spark, store, d).select(cols)) == key(cp.dataset_statistics(df, d))
    for method in ("neg_pos", "balanced", "inverse_frequency", "none"):
        for splits in (None, ["train"]):
            assert (key(inc.merged_class_weights(spark, store, d, method, splits))
                    == key(cp.class_weights(df, d, method, splits)))
    empty = scratch_path(spark, "store")
    inc.record_batch(df.limit(0), 0, empty, d)
    assert inc.merged_statistics(spark, empty, d).collect() == []

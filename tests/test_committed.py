"""Batches that are committed whole or not at all."""

from labelfold.sources import committed as cm

SCHEMA = "id long, split string"


def rows(spark, path):
    return sorted((r.id, r.split, r.batch) for r in cm.read_committed(spark, path, SCHEMA).collect())


def batch(spark, ids):
    return spark.createDataFrame([(i, "train" if i % 2 else "valid") for i in ids], SCHEMA)


def test_repeated_and_failed_writes_leave_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "store")
    assert rows(spark, path) == [] and cm.remove_stale(spark, path) == 0
    for b in (0, 1, 0, 1):  # each written twice
        cm.append_batch(batch(spark, range(b * 10, b * 10 + 10)), path, b, ("split",))
    want = [(i, "train" if i % 2 else "valid", i // 10) for i in range(20)]
    assert rows(spark, path) == want
    cm.write_attempt(batch(spark, range(5)), path, 1, ("split",))  # never committed
    cm.write_attempt(batch(spark, range(5)), path, 7, ("split",))
    assert rows(spark, path) == want
    assert cm.remove_stale(spark, path) == 4 and rows(spark, path) == want
    assert cm.read_committed(spark, path, SCHEMA).filter("split = 'train'").count() == 10


def test_a_later_commit_replaces_the_batch(spark, tmp_path):
    path = str(tmp_path / "store")
    cm.append_batch(batch(spark, range(4)), path, 3)
    before = cm.read_committed(spark, path, SCHEMA)
    cm.append_batch(batch(spark, [9]), path, 3)
    assert rows(spark, path) == [(9, "train", 3)]
    assert before.count() == 4  # a reader keeps what it has listed
    cm.append_batch(batch(spark, []), path, 3)
    assert rows(spark, path) == []


def test_as_a_stream_sink(spark, tmp_path):
    src, path = str(tmp_path / "src"), str(tmp_path / "store")
    batch(spark, range(30)).repartition(3).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    for restart in ("a", "b"):  # the second run has lost its offsets and repeats all batches
        q = stream.writeStream.foreachBatch(lambda d, i: cm.append_batch(d, path, i)).option(
            "checkpointLocation", str(tmp_path / f"ckpt-{restart}")).trigger(availableNow=True).start()
        q.awaitTermination()
    assert [r[0] for r in rows(spark, path)] == list(range(30))

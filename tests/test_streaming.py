"""Streaming history over several micro-batches equals the batch query."""

import datetime as dt

from labelfold.session import scratch_path
from labelfold.streaming import history as hs

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def _events(start, n, hot_share):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for j in range(n):
        e = start + j
        user = 1 if j % hot_share != 0 else 2 + (e % 5)  # user 1 holds most rows
        rows.append((e, base + dt.timedelta(seconds=(e * 7919) % 100000), user,
                     ("click", "view", "purchase")[e % 3], float(e % 13)))
    return rows


def test_history_stream_matches_batch_over_batches(spark):
    src = scratch_path(spark, "events-src")
    parts = [_events(0, 400, 4), _events(400, 300, 3), _events(700, 200, 5)]
    parts[2].append(parts[1][0])  # a replayed event must not be counted twice
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{src}/part={i}")
    static = spark.read.parquet(src).drop("part").dropDuplicates(["event_id"])
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    sink = scratch_path(spark, "history-sink")
    q = hs.recent_history_stream(stream, sink, scratch_path(spark, "history-ckpt"), n=10)
    q.awaitTermination()
    assert q.lastProgress is not None and q.lastProgress["batchId"] >= 2  # several batches
    got = sorted((r["user_id"], r["rank"], r["event_id"])
                 for r in hs.latest_lists(spark, sink).collect())
    want = sorted((r["user_id"], r["rank"], r["event_id"]) for r in
                  hs.recent_history(static, "user_id", ["ts", "event_id"], 10).collect())
    assert got == want


def test_history_clear_stream_matches_batch(spark):
    src = scratch_path(spark, "events-clear-src")
    base = dt.datetime(2024, 1, 1)
    ev = lambda e, sec, user, kind: (e, base + dt.timedelta(seconds=sec), user, kind, float(e))
    parts = [
        [ev(i, i * 10, 1, "click") for i in range(30)] + [ev(100 + i, i * 10 + 5, 2, "view") for i in range(5)],
        [ev(200, 295, 1, "signup")] + [ev(201 + i, 300 + i * 10, 1, "view") for i in range(4)]
        + [ev(300, 1000, 2, "signup")],                      # user 2 ends empty
        [ev(400, 100, 1, "click"), ev(401, 900, 1, "click"),  # 400 is older than the clear
         ev(402, 50, 3, "click")],
    ]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{src}/part={i}")
    static = spark.read.parquet(src).drop("part")
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    sink = scratch_path(spark, "history-clear-sink")
    q = hs.recent_history_stream(stream, sink, scratch_path(spark, "history-clear-ckpt"), n=3,
                                 clear_type="signup")
    q.awaitTermination()
    got = sorted((r["user_id"], r["rank"], r["event_id"]) for r in hs.latest_lists(spark, sink).collect())
    want = sorted((r["user_id"], r["rank"], r["event_id"]) for r in
                  hs.recent_history(static, "user_id", ["ts", "event_id"], 3,
                                    clear="event_type = 'signup'").collect())
    assert got == want
    assert [e for u, _, e in got if u == 1] == [401, 204, 203] and not [1 for u, _, _ in got if u == 2]


def test_queries_stream_tables_that_are_folders(spark):
    """A table as a folder of part files gives what the same rows as one file give, and no file of another table."""
    import pytest
    from pyspark.sql import functions as F
    from labelfold.plans.catalog_live import q_early_stop_stream
    from labelfold.plans import catalog as c

    emb = spark.createDataFrame([(i, [float(i % 3), 1.0, float(i % 7)], i % 10) for i in range(60)],
                                "vec_id long, embedding array<float>, label int")
    docs = spark.createDataFrame([(i, None if i % 5 == 0 else f"text {i}") for i in range(90)], "doc_id long, text string")
    events = spark.createDataFrame(_events(0, 300, 4), SCHEMA).withColumn(
        "event_type", F.when(F.col("event_id") % 9 == 0, "signup").otherwise(F.col("event_type")))
    tables = {"embeddings": emb, "documents": docs, "events": events}
    folders, files = scratch_path(spark, "tables"), scratch_path(spark, "tables")
    for name, df in tables.items():
        df.repartition(3).write.parquet(f"{folders}/{name}.parquet")
        df.coalesce(1).write.parquet(f"{files}/parts/{name}")
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(files)
        fs = root.getFileSystem(conf)
        part = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{files}/parts/{name}/part-*"))[0].getPath()
        fs.rename(part, jvm.org.apache.hadoop.fs.Path(f"{files}/{name}.parquet"))
    for query, rows in ((c.q_score_stream, 1), (c.q_score_stream_rejected, 1), (c.q_recent_history_stream, 1),
                        (c.q_recent_history_clear_stream, 1), (q_early_stop_stream, 0)):
        a, b = [sorted(map(str, query(spark, d).collect())) for d in (folders, files)]
        assert a == b and len(a) >= rows, query.__name__
    assert c.q_score_stream(spark, folders).count() == 55  # vec_id % 12 = 11 is refused
    with pytest.raises(Exception):
        c.q_score_stream(spark, scratch_path(spark, "no-table"))

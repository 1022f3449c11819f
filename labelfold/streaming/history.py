"""Latest n results per key (the prediction page's history, capped at 10).

Batch: ``row_number() over (partition by key order by ts desc) <= n``.  Spark
plans this with a partial WindowGroupLimit before the shuffle, so each task
forwards at most n rows per key and a hot key never reaches one task whole.

Stream: ``applyInPandasWithState`` keeps at most n rows of state per key and
folds each micro-batch chunk by chunk, so memory per key stays bounded.

Clearing (the page's "clear history"): records marked as clears remove a
key's earlier rows, in batch and in stream alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HISTORY_LIMIT = 10  # fixed value: entries kept per user
# timestamp_ntz <-> microseconds without the session time zone
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def recent_history(df: DataFrame, key: str, order: list, n: int = HISTORY_LIMIT,
                   clear: str | None = None) -> DataFrame:
    """Latest n rows per key, newest first (rank 1 = newest).

    ``clear`` (a SQL condition) marks clear records: a key's rows at or
    before its latest clear, in ``order``, are gone, and clear records are
    not listed.  Rows after a clear are the newest of their key, so each key is
    cut to its n newest rows first (a partial limit before the shuffle, whatever
    the key's share) and only those meet the latest clear: at most n rows a key
    reach the join."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])

    def newest(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)

    if clear is None:
        return newest(df)
    is_clear = F.coalesce(F.expr(clear), F.lit(False))
    pos = F.struct(*[F.col(c) for c in order])
    marks = df.filter(is_clear).groupBy(key).agg(F.max(pos).alias("_clear"))
    return (newest(df.filter(~is_clear)).join(marks, key, "left")
            .filter(F.col("_clear").isNull() | (pos > F.col("_clear"))).drop("_clear"))


STATE_SCHEMA = ("ids array<long>, ts array<long>, kinds array<string>, vals array<double>, "
                "version long, clear_ts long, clear_id long")
OUT_SCHEMA = "user_id long, event_id long, ts_us long, event_type string, value double, rank int, version long"
COLS = ["event_id", "ts_us", "event_type", "value"]


def _keep_latest(n: int, clear_type: str | None = None):
    import pandas as pd

    def fn(key, pdfs, state):
        if state.exists:
            ids, ts, kinds, vals, version, clear_ts, clear_id = state.get
            cur = pd.DataFrame({"event_id": list(ids), "ts_us": list(ts), "event_type": list(kinds),
                                "value": list(vals)})
        else:
            cur = pd.DataFrame({c: [] for c in COLS})
            version, clear_ts, clear_id = 0, None, None
        for pdf in pdfs:  # Arrow chunks of the group: state never exceeds n rows
            pdf = pdf[COLS]
            if clear_type is not None:
                marks = pdf[pdf["event_type"] == clear_type]
                if len(marks):
                    last = marks.sort_values(["ts_us", "event_id"]).iloc[-1]
                    mark = (int(last["ts_us"]), int(last["event_id"]))
                    if clear_ts is None or mark > (clear_ts, clear_id):
                        clear_ts, clear_id = mark
                pdf = pdf[pdf["event_type"] != clear_type]
            both = pd.concat([cur, pdf], ignore_index=True).drop_duplicates("event_id", keep="last")
            if clear_ts is not None:
                after = (both["ts_us"] > clear_ts) | ((both["ts_us"] == clear_ts)
                                                      & (both["event_id"] > clear_id))
                both = both[after]
            cur = both.sort_values(["ts_us", "event_id"], ascending=False).head(n)
        version += 1
        cur = cur.reset_index(drop=True)
        state.update((cur["event_id"].astype("int64").tolist(), cur["ts_us"].astype("int64").tolist(),
                      cur["event_type"].tolist(), cur["value"].astype(float).tolist(), int(version),
                      clear_ts, clear_id))
        if len(cur) == 0:
            # an emptied list still gets a version, so the sink stops showing the old one
            yield pd.DataFrame({"user_id": [key[0]], "event_id": pd.array([None], dtype="Int64"),
                                "ts_us": pd.array([None], dtype="Int64"), "event_type": [None],
                                "value": [None], "rank": [0], "version": [int(version)]})
            return
        yield pd.DataFrame({"user_id": [key[0]] * len(cur), "event_id": cur["event_id"].astype("int64"),
                            "ts_us": cur["ts_us"].astype("int64"), "event_type": cur["event_type"],
                            "value": cur["value"].astype(float), "rank": range(1, len(cur) + 1),
                            "version": [int(version)] * len(cur)})
    return fn


PARTIAL_SCHEMA = "user_id long, event_id long, ts_us long, event_type string, value double"


def _partial_latest(n: int, clear_type: str | None = None):
    """Map side: keep at most n newest events (and the newest clear record)
    per user in every Arrow batch, so a hot user sends at most n + 1 rows per
    batch into the stateful shuffle.  A dropped event has n newer ones in its
    batch, so it could never be listed: a clear that removes those removes it
    too."""
    def fn(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            pdf = pdf.drop_duplicates("event_id", keep="last").sort_values(
                ["ts_us", "event_id"], ascending=False)
            if clear_type is None:
                yield pdf.groupby("user_id", sort=False).head(n)
                continue
            is_clear = pdf["event_type"] == clear_type
            yield pdf[~is_clear].groupby("user_id", sort=False).head(n)
            yield pdf[is_clear].groupby("user_id", sort=False).head(1)
    return fn


def recent_history_stream(stream: DataFrame, sink_path: str, checkpoint: str, n: int = HISTORY_LIMIT,
                          clear_type: str | None = None):
    """G2 (stream): keep the latest n events per user in state; every batch
    appends the users' current lists with a version; replays are keyed on
    event_id so they never duplicate an event.  Events of ``clear_type``
    clear the user's list (the state remembers the latest clear, so a late
    event from before it stays cleared).

    Each micro-batch is first cut to the latest n events per user inside
    every map-side Arrow batch (a partial top-n, as the batch plan's partial
    window limit), then merged with the state of at most n rows per user."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    prepared = stream.select("user_id", "event_id",
                             F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, ts)").alias("ts_us"),
                             "event_type", "value")
    prepared = prepared.mapInPandas(_partial_latest(n, clear_type), PARTIAL_SCHEMA)
    out = prepared.groupBy("user_id").applyInPandasWithState(
        _keep_latest(n, clear_type), OUT_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")

    return (out.writeStream.outputMode("update").foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_lists(spark, sink_path: str) -> DataFrame:
    """Current list per user: the rows of each user's highest version (an
    emptied list is one marker row without an event, dropped here)."""
    out = spark.read.parquet(sink_path)
    # rank() = 1 keeps a partial group limit before the shuffle: old versions stay in their tasks
    w = Window.partitionBy("user_id").orderBy(F.col("version").desc())
    latest = out.withColumn("_v", F.rank().over(w)).filter(F.col("_v") == 1)
    return latest.filter(F.col("event_id").isNotNull()).select(
        "user_id", "event_id", F.expr(f"timestampadd(MICROSECOND, ts_us, {EPOCH_NTZ})").alias("ts"),
        "event_type", "value", "rank")

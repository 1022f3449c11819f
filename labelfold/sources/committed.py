"""A5/F1: appended batches that are there whole or not at all, and once however often written.

A batch is written into a folder of its own attempt; a manifest that names the attempt is then
put in place by one atomic rename.  Readers list the manifests and read only what they name, so
a batch that failed half-way, or files of a writer still at work, are never seen, and a repeated
batch replaces its earlier try in the moment its manifest does.  ``remove_stale`` deletes the
attempts that no manifest names.

    path/data/batch=<id>/attempt=<hex>/[<partition column>=.../]part-*.parquet
    path/manifest/<id>.json                  {"batch": <id>, "attempt": "<hex>"}

Defined results: an empty batch is a batch without rows; a store without batches has no rows (its
schema must be given); two writers of one batch id at the same time leave one of the two whole.
Manifests are one row per batch, and listing them is the only driver work.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _files(spark: SparkSession, path: str):
    """(Path class, its file context) of a store on any Hadoop file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    make = jvm.org.apache.hadoop.fs.Path
    return make, make(path).getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(make(path).toUri(), conf)


def write_attempt(df: DataFrame, path: str, batch: int, partition_by: tuple = ()) -> str:
    """Write a batch without committing it; returns the attempt."""
    attempt = uuid.uuid4().hex
    df.write.partitionBy(*partition_by).parquet(f"{path}/data/batch={int(batch)}/attempt={attempt}")
    return attempt


def commit_attempt(spark: SparkSession, path: str, batch: int, attempt: str) -> None:
    """Make an attempt the batch's only one, by one atomic rename."""
    make, fs, files = _files(spark, path)
    made = make(f"{path}/manifest/_{attempt}")  # names with an underscore are no manifests yet
    out = fs.create(made, True)
    out.write(bytearray(json.dumps({"batch": int(batch), "attempt": attempt}).encode()))
    out.close()
    gateway = spark.sparkContext._gateway
    rename = gateway.jvm.org.apache.hadoop.fs.Options.Rename
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    files.rename(files.makeQualified(made), files.makeQualified(make(f"{path}/manifest/{int(batch)}.json")), how)


def append_batch(df: DataFrame, path: str, batch: int, partition_by: tuple = ()) -> None:
    """Write and commit a batch; fits ``foreachBatch``, which may repeat a batch after a restart."""
    commit_attempt(df.sparkSession, path, batch, write_attempt(df, path, batch, partition_by))


def committed(spark: SparkSession, path: str) -> dict[int, str]:
    """Attempt of every committed batch."""
    make, fs, _ = _files(spark, path)
    if not fs.exists(make(f"{path}/manifest")):
        return {}
    rows = spark.read.schema("batch long, attempt string").json(f"{path}/manifest").collect()
    return {r.batch: r.attempt for r in rows}


def read_committed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The rows of all committed batches with their ``batch``; ``schema`` names the written columns."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("attempt", T.StringType())])
    folders = [f"{path}/data/batch={b}/attempt={a}" for b, a in sorted(committed(spark, path).items())]
    if not folders:
        return spark.createDataFrame([], whole).drop("attempt")
    return spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*folders).drop("attempt")


def remove_stale(spark: SparkSession, path: str) -> int:
    """Delete the attempts no manifest names; call it when no writer is at work.  Returns how many."""
    make, fs, _ = _files(spark, path)
    held, done = committed(spark, path), 0
    data = make(f"{path}/data")
    for batch in fs.listStatus(data) if fs.exists(data) else []:
        keep = held.get(int(batch.getPath().getName()[len("batch="):]))
        for attempt in fs.listStatus(batch.getPath()):
            if attempt.getPath().getName() != f"attempt={keep}":
                done += bool(fs.delete(attempt.getPath(), True))
    return done

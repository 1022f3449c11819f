"""Shared helpers of the training-data operators."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelfold.session import scratch_path

#: White space of the contracts: the space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(col: str) -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def through_table(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table into the shared folder and read it back.

    Cuts the lineage with files that outlive any executor and keeps later
    passes from computing it again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smallest_hashes(df: DataFrame, cols: list[str], n: int) -> DataFrame:
    """The different rows (by ``cols``) with the n smallest hashes, in hash order: a bounded
    sample that any partitioning gives alike.  Hashes alone find the limit, so texts above
    it never move."""
    h = F.xxhash64(*cols)
    limit = df.select(h.alias("h")).distinct().orderBy("h").limit(n).agg(F.max("h")).first()[0]
    if limit is None:
        return df.limit(0)
    return df.filter(h <= limit).withColumn("_h", h).dropDuplicates(["_h"]).orderBy("_h").drop("_h")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared location for files that tasks write themselves."""
    return scratch_path(spark, name)


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a shared location; runs on driver and executors."""
    from pyarrow import fs

    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    return fs.FileSystem.from_uri(uri)

"""Sources and sinks for labelled corpora and their metadata.

CSV is read with an explicit schema (no inference pass) and RFC-4180 quoting (a
doubled quote inside a quoted field, line breaks in quotes), which matches how
pandas writes the corpus files.  A file is read by as many tasks as it has byte
ranges (``split_csv``); ``splittable=False`` takes Spark's ``multiLine`` reader, one
task per file, which also reads files with quotes in unquoted fields.  Metadata (weights, label info, statistics) are K-row tables
written as single small JSON files.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dictionary import LabelDictionary, dictionary_from_info
from .committed import append_batch
from .split_csv import read_quoted_csv

CSV_READ = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "quoteAll": "false",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """A1: load a raw split (parquet, json or csv)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.options(**CSV_READ)
    if fmt == "json":
        r = r.option("multiLine", "false")
    return r.load(path)


def labeled_schema(labels: LabelDictionary, text_col: str = "text", extra=None) -> T.StructType:
    fields = [T.StructField(c, t, True) for c, t in (extra or [])]
    fields.append(T.StructField(text_col, T.StringType(), True))
    fields += [T.StructField(n, T.IntegerType(), True) for n in labels.names]
    return T.StructType(fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, splittable: bool = True) -> DataFrame:
    """CSV files with a header each, by many tasks a file or by one."""
    if splittable:
        return read_quoted_csv(spark, path, schema)
    return spark.read.schema(schema).options(**CSV_READ).csv(path)


def read_labeled_csv(spark: SparkSession, path: str, labels: LabelDictionary, extra=None,
                     splittable: bool = True) -> DataFrame:
    """A2: the wide labelled CSV (text + one int column per label)."""
    return read_csv(spark, path, labeled_schema(labels, extra=extra), splittable)


def format_label_list(arr) -> F.Column:
    """Array -> '[0, 1, 0]' (the corpus files' list text)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.concat(F.lit("["), F.array_join(a.cast("array<string>"), ", "), F.lit("]"))


def parse_label_list(text) -> F.Column:
    """A3: '[0, 1]' or '[0.0, 1.0]' -> array<int> (parsed as doubles, then cast)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.from_json(t, "array<double>").cast("array<int>")


def read_label_list_csv(spark: SparkSession, path: str, extra=None, splittable: bool = True) -> DataFrame:
    """A3: (extra..., text, labels array<int>)."""
    fields = [T.StructField(c, t, True) for c, t in (extra or [])]
    fields += [T.StructField("text", T.StringType(), True), T.StructField("labels", T.StringType(), True)]
    df = read_csv(spark, path, T.StructType(fields), splittable)
    return df.withColumn("labels", parse_label_list("labels"))


def read_label_dictionary(spark: SparkSession, path: str) -> LabelDictionary:
    """A4: label info JSON -> dictionary (K entries; falls back to the default)."""
    rows = spark.read.option("multiLine", "true").json(path).limit(1).collect()
    if not rows:
        return dictionary_from_info(None)
    info = rows[0].asDict(recursive=True)
    return dictionary_from_info(info)


def write_labeled(df: DataFrame, path: str, fmt: str = "parquet", split_col: str = "split",
                  mode: str = "overwrite") -> None:
    """A5: write the wide frame partitioned by split ("all" = unfiltered read)."""
    w = df.write.mode(mode).partitionBy(split_col)
    if fmt == "csv":
        w.options(**CSV_WRITE).csv(path)
    else:
        w.format(fmt).save(path)


def append_labeled(df: DataFrame, path: str, batch: int, split_col: str = "split") -> None:
    """A5 for a growing corpus: a batch of the wide frame, partitioned by split, that is there whole or not at
    all and once however often it is written; ``committed.read_committed`` reads it."""
    append_batch(df, path, batch, (split_col,))


def write_label_list(df: DataFrame, labels: LabelDictionary, path: str, fmt: str = "csv",
                     keep=("text",), split_col: str | None = "split", mode: str = "overwrite") -> None:
    """The array form; CSV stores the list as text."""
    arr = F.array(*[F.col(f"`{n}`").cast("int") for n in labels.names])
    cols = [F.col(c) for c in keep]
    if split_col:
        cols.append(F.col(split_col))
    out = df.select(*cols, (format_label_list(arr) if fmt == "csv" else arr).alias("labels"))
    w = out.write.mode(mode)
    if split_col:
        w = w.partitionBy(split_col)
    if fmt == "csv":
        w.options(**CSV_WRITE).csv(path)
    else:
        w.format(fmt).save(path)


def write_metadata(path: str, weights: DataFrame | None = None, labels: LabelDictionary | None = None,
                   statistics: DataFrame | None = None, spark: SparkSession | None = None) -> None:
    """Class weights, label info and statistics as small JSON tables."""
    if weights is not None:
        weights.coalesce(1).write.mode("overwrite").json(f"{path}/class_weights")
    if statistics is not None:
        statistics.coalesce(1).write.mode("overwrite").json(f"{path}/dataset_statistics")
    if labels is not None:
        spark = spark or (weights or statistics).sparkSession
        info = spark.createDataFrame([(labels.to_json(),)], "info string")
        info.coalesce(1).write.mode("overwrite").text(f"{path}/label_info")


def read_class_weights(spark: SparkSession, path: str) -> DataFrame:
    """(label_idx, label, n_pos, n_neg, pos_weight)."""
    schema = ("label_idx int, label string, n_pos long, n_neg long, pos_weight double")
    return spark.read.schema(schema).json(f"{path}/class_weights")


STATISTICS_SCHEMA = ("split string, total_samples long, avg_labels_per_sample double, max_labels_per_sample long, "
                     "samples_with_no_labels long, samples_with_multiple_labels long, label_idx int, label string, "
                     "count long, percentage double")


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """The dataset statistics, one row per split and label."""
    return spark.read.schema(STATISTICS_SCHEMA).json(f"{path}/dataset_statistics")


def read_label_info(spark: SparkSession, path: str) -> LabelDictionary:
    rows = spark.read.text(f"{path}/label_info").limit(1).collect()
    return dictionary_from_info(json.loads(rows[0]["value"]) if rows else None)

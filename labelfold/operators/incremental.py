"""C1-C5 over a growing corpus: partial states per batch, merged without rescanning.

Corpus statistics and class weights are functions of a few sums per split.  A batch of
rows leaves one row of sums per split in a store, a Parquet folder partitioned by
``batch_id``; writing a batch replaces its own partition and touches no other.  So a
batch may be replayed any number of times (a restarted stream, a retried job) and
batches may come in any order: the merged result is that of all rows read once, exactly,
as the sums are integers.  Merging reads the store alone, (splits x batches) rows.

Defined results: rows with a null split are a split of that name; a batch without rows leaves
none; a replayed batch with other rows replaces the earlier ones; an empty store gives no
statistics and weights of no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqltext as X
from ..functions.dictionary import LabelDictionary
from .corpus import statistics_of_rows, weights_of_counts

SUMS = ("n", "card_sum", "none", "several")


def _schema(labels: LabelDictionary) -> str:
    return ", ".join(["split string", *[f"{c} long" for c in (*SUMS, "card_max")],
                      *[f"c_{i} long" for i in range(labels.k)], "batch_id long"])


def partial_statistics(df: DataFrame, labels: LabelDictionary, by: str = "split") -> DataFrame:
    """One row of sums per split of a batch, combined in the scan tasks."""
    bits = [f"CAST({X.ident(n)} AS BIGINT)" for n in labels.names]
    card = " + ".join(bits)
    aggs = ["count(1) AS n", f"sum({card}) AS card_sum", f"count_if(({card}) = 0) AS none",
            f"count_if(({card}) > 1) AS several", f"max({card}) AS card_max", *[f"sum({b}) AS c_{i}" for i, b in enumerate(bits)]]
    return df.groupBy(F.col(by).cast("string").alias("split")).agg(*[F.expr(a) for a in aggs])


def record_batch(df: DataFrame, batch_id: int, store: str, labels: LabelDictionary, by: str = "split") -> None:
    """Put a batch's sums into the store, in place of what an earlier try of the batch left.

    Fits ``foreachBatch``: ``lambda df, i: record_batch(df, i, store, labels)``."""
    # as the folder's own overwrite, so that a batch that has become empty leaves nothing behind
    partial_statistics(df, labels, by).write.mode("overwrite").parquet(f"{store}/batch_id={int(batch_id)}")


def _merged(spark: SparkSession, store: str, labels: LabelDictionary) -> DataFrame:
    return spark.read.schema(_schema(labels)).parquet(store)


def merged_statistics(spark: SparkSession, store: str, labels: LabelDictionary) -> DataFrame:
    """``dataset_statistics`` of all recorded batches."""
    sums = [F.sum(c).alias(c) for c in (*SUMS, *[f"c_{i}" for i in range(labels.k)])]
    rolled = _merged(spark, store, labels).rollup("split").agg(
        *sums, F.max("card_max").alias("card_max"), F.grouping("split").alias("g"))
    rows = rolled.withColumn("split", F.when(F.col("g") == 1, F.lit("all")).otherwise(F.col("split"))).filter("n > 0")
    return statistics_of_rows(rows, labels)


def merged_class_weights(spark: SparkSession, store: str, labels: LabelDictionary, method: str = "neg_pos",
                         splits: list | None = ("train",), drop_empty: bool = False) -> DataFrame:
    """``class_weights`` of all recorded batches."""
    parts = _merged(spark, store, labels)
    if splits is not None:
        parts = parts.filter(F.col("split").isin(list(splits)))
    row = parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                    *[F.coalesce(F.sum(f"c_{i}"), F.lit(0)).alias(f"c_{i}") for i in range(labels.k)])
    return weights_of_counts(row, labels, method, drop_empty)

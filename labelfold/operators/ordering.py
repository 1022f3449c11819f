"""Order-dependent work without putting a group into one task.

``global_index`` numbers rows 0..N-1 in a global order: a range-partitioned
sort (balanced by sampling, so one huge group is split across many tasks),
``monotonically_increasing_id`` inside each sorted partition, and partition
offsets from a table of at most #partitions rows.  The sorted, numbered frame
is reliably checkpointed into the shared folder so the numbering never
changes under recomputation after an executor loss.

``chunked_fold`` folds an associative operation over each group's rows in
that order: rows are cut into chunks of C consecutive indices, each chunk is
folded by one bounded ``collect_list`` + ``aggregate``, then chunks of chunks,
until one value per group remains (log_C N levels, each on C-times fewer
rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def global_index(df: DataFrame, order_cols: list, name: str = "gidx",
                 checkpoint: bool = True) -> DataFrame:
    """Add ``name`` = 0-based position of the row in ``orderBy(order_cols)``."""
    s = df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    if checkpoint:
        s = cut_lineage(s)
    s = s.withColumn("_pid", F.shiftrightunsigned(F.col("_mid"), ROW_BITS)) \
         .withColumn("_row", F.col("_mid").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    # one row per partition: the broadcast is bounded by the partition count
    out = s.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_off") + F.col("_row")).drop("_mid", "_pid", "_row", "_off")


def chunked_fold(rows: DataFrame, group_cols: list, index_col: str, value_col: str,
                 zero: Column, combine, chunk: int = 4096, max_rows: int | None = None) -> DataFrame:
    """Fold ``value_col`` over each group in ``index_col`` order.

    ``combine(acc, x)`` must be associative with identity ``zero``; indices of
    a group must be consecutive and below ``max_rows`` (default 2**45): the
    fold stops at the first level whose chunks span all of them, so it takes
    ceil(log_chunk(max_rows)) aggregate levels.  Returns (group_cols..., folded).
    """
    limit = max(int(max_rows if max_rows is not None else 1 << 45), 1)
    level = rows.select(*group_cols, F.col(index_col).alias("_i"), F.col(value_col).alias("_v"))
    span = 1
    while span == 1 or span < limit:
        span *= chunk
        level = (level.withColumn("_c", F.floor(F.col("_i") / F.lit(float(span))).cast("long"))
                 .groupBy(*group_cols, "_c")
                 .agg(F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_xs"),
                      F.min("_i").alias("_imin"))
                 .select(*group_cols, F.col("_imin").alias("_i"),
                         F.aggregate("_xs", zero, lambda acc, x: combine(acc, x["_v"])).alias("_v")))
    return level.select(*group_cols, F.col("_v").alias("folded"))

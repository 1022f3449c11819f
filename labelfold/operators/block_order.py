"""B4 at scale: a reproducible order per epoch by permuted blocks, without a range exchange.

``shuffle_rows(sort=True)`` sorts by a random key: Spark samples the input to cut ranges, so it
is read twice.  Here rows belong to ``side * side`` blocks by a hash of their key, the same in
every epoch (write them by block once and each epoch reads whole blocks).  An epoch moves the
blocks by a keyed permutation of their numbers and orders the rows of a block by a hash of key,
seed and epoch.  A block's place gives its partition directly, so one exchange without sampling
puts the epoch's order over the partitions, and a sort inside each partition ends it.

The permutation is a Feistel network over the digits of the block's number in base ``side``:
each half step adds a hash of one digit to the other modulo ``side``, which can be undone, so
every block gets its own place for any ``side``; no table of blocks is held anywhere.

Defined results: rows of equal or null keys lie side by side in one block (a key should be
unique; a hot one makes a hot block); an empty frame stays empty; all columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .corpus import portable_hash, shuffle_key

HALF_STEPS = 6


def permuted(number: Column, side: int, seed: int, epoch: int) -> Column:
    """The place of each number of 0 .. side*side - 1 in this epoch's permutation."""
    digits = [F.floor(number / F.lit(side)).cast("long"), (number % F.lit(side)).cast("long")]
    for step in range(HALF_STEPS):
        # the digit that moves, by a hash of the one that stands still
        moved = (digits[step % 2] + portable_hash(F.lit(seed), F.lit(epoch), F.lit(step), digits[1 - step % 2])) % F.lit(side)
        digits[step % 2] = moved
    return digits[0] * F.lit(side) + digits[1]


def with_blocks(df: DataFrame, key: str, side: int = 64, seed: int = 42) -> DataFrame:
    """Adds ``block``, the same in every epoch."""
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return df.withColumn("block", portable_hash(k, F.lit(seed)) % F.lit(side * side))


def shuffle_blocks(df: DataFrame, key: str, side: int = 64, seed: int = 42, epoch: int = 0,
                   partitions: int | None = None, portable: bool = False) -> DataFrame:
    """The rows with ``block``, ``place`` (the block's this epoch) and ``shuffle_key``; partition after
    partition they stand in the order (place, shuffle_key, key)."""
    blocks = side * side
    n = min(blocks, partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = with_blocks(df, key, side, seed)
    # side*side distinct numbers at most: the hashes of a permutation are few against the rows' own
    placed = (placed.withColumn("place", permuted(F.col("block"), side, seed, epoch))
              .withColumn("shuffle_key", shuffle_key(F.col(key), seed, epoch, portable)))
    dealt = placed.repartitionById(n, F.floor(F.col("place") * F.lit(n) / F.lit(blocks)).cast("int"))
    return dealt.sortWithinPartitions("place", "shuffle_key", key)

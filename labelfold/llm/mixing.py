"""Operator 8: mixing sources to target weights.

Every source's words are packed, in a pseudorandom order of its documents,
into blocks of a fixed number of words.  A source's target gives it a number of
slots; each output shard draws its source counts from a multinomial over what
is left of the targets, and a slot's rank in its source goes through a
per-source, per-pass pseudorandom permutation of the block indexes.  Joining
slots to blocks on (source, block) yields what each document contributes.

Scale: texts are read once for their sizes and never shuffled.  Offsets inside
a source come from two sums (over hash buckets of a few thousand rows each,
then inside a bucket), so a source with a third of all rows is never sorted by
one task; rows of equal id and size are counted before they are sorted, so null or
equal ids are no hot bucket either.  Slots are written into the shared folder and meet
the blocks by a shuffle on (source, block), which is unique per pass: both grow with the
data, so neither is broadcast.  A task holds ``SLOT_ROWS`` slots at a time.
The driver holds one row per source (at most ``max_sources``, else it fails)
and one count per source and shard (at most ``MAX_SHARDS`` shards, which grow beyond that).

Defined results: a null text is empty and has size 0; a document of size 0
is never taken; a null source is a source of its own, last in order; a repeated
row is a document of its own; an empty table gives an empty table; reruns
agree, since every order and draw depends on ids, sizes and the seed only.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelfold.llm.common import WORD, text_of, through_table

#: Upper bound of output shards, and so of the driver's table of draws.
MAX_SHARDS = 4096
#: Slots a task makes at a time.
SLOT_ROWS = 1 << 16


def targets(sizes: list[int], weights=(5, 2, 1), share=Fraction(3, 2), stop: int = 2) -> list[Fraction]:
    """Words to take from each source, in source order: ``share`` of all words by
    weight, each stopped at ``stop`` times its source, the excess shared anew."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out: list[Fraction] = [Fraction(0)] * len(sizes)
    left, open_ = share * sum(sizes), [i for i, s in enumerate(sizes) if s]
    while open_:
        unit = Fraction(left) / sum(w[i] for i in open_)
        over = [i for i in open_ if unit * w[i] > stop * sizes[i]]
        if not over:
            for i in open_:
                out[i] = unit * w[i]
            break
        for i in over:
            out[i] = Fraction(stop * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


def draw_shards(slots: list[int], shard_slots: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(shard, source, first slot rank, count): multinomial draws over what is left."""
    left = np.array(slots, dtype=np.int64)
    total = int(left.sum())
    n_shards = max(1, min(MAX_SHARDS, -(-total // shard_slots)))
    rng, done, out = np.random.default_rng(seed), np.zeros_like(left), []
    for shard in range(n_shards):
        want = total * (shard + 1) // n_shards - total * shard // n_shards
        got = np.zeros_like(left)
        while (short := want - int(got.sum())) > 0:  # what a used-up source can't give is drawn again
            rest = left - got
            got += np.minimum(rng.multinomial(short, rest / rest.sum()), rest)
        for s in np.flatnonzero(got):
            out.append((shard, int(s), int(done[s]), int(got[s])))
        left, done = left - got, done + got
    return out


def permute(pos: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 (four Feistel rounds, walked back into range)."""
    if n < 2:
        return pos.copy()
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, k = np.uint64((1 << half) - 1), np.uint64(key & (2**64 - 1))

    def once(x):
        a, b = x >> np.uint64(half), x & mask
        for r in range(4):
            f = (b + k + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, (a ^ (f >> np.uint64(32))) & mask
        return (a << np.uint64(half)) | b

    out = once(pos.astype(np.uint64))
    while (far := out >= np.uint64(n)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def _slots(block: int, seed: int):
    def run(batches):
        for df in batches:
            for d, part in ((d, p) for d in df.itertuples(index=False) for p in range(0, d.count, SLOT_ROWS)):
                r = np.arange(d.first + part, d.first + min(d.count, part + SLOT_ROWS), dtype=np.int64)
                whole, short = d.size // block, d.size % block
                per_pass = whole + (short > 0)
                turn, pos = r // per_pass, r % per_pass
                index = np.where(pos < whole, 0, whole)
                for t in np.unique(turn):
                    at = (turn == t) & (pos < whole)
                    index[at] = permute(pos[at], int(whole), hash((seed, int(d.sid), int(t))))
                take = np.where(index < whole, block, short)
                passes, rest = divmod(d.quota, d.size)
                if rest:  # the last slot of a source may take a part of its block
                    take[r == passes * per_pass + -(-rest // block) - 1] = rest - (-(-rest // block) - 1) * block
                yield pd.DataFrame({"shard": d.shard, "slot": part + np.arange(len(r)), "sid": d.sid,
                                    "block": index, "take": take})
    return run


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=(5, 2, 1), share=Fraction(3, 2), stop: int = 2, block: int = 512,
             shard_slots: int = 8192, bucket_rows: int = 4096, max_sources: int = 100_000,
             seed: int = 20) -> dict[str, DataFrame]:
    """The mix as tables: ``sources`` (sid, source, source_size, target), ``slots``
    (shard, slot, sid, block, take), ``pieces`` (id, size, sid, off, block, begin,
    end: the words of a block that a document fills) and ``empty`` (id, size, sid:
    documents without words)."""
    spark = docs.sparkSession
    sized = through_table(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size")), "mix-sizes")
    stats = (sized.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
             .orderBy(F.col("source").asc_nulls_last()).limit(max_sources + 1).collect())
    if len(stats) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    sizes, goal = [int(r.words) for r in stats], targets([int(r.words) for r in stats], weights, share, stop)
    quota = [round(t) for t in goal]
    slots = [q // s * -(-s // block) + -(-(q % s) // block) if s else 0 for q, s in zip(quota, sizes)]
    sources = spark.createDataFrame(
        [(i, r.source, sizes[i], float(goal[i])) for i, r in enumerate(stats)],
        "sid int, source string, source_size long, target double")
    draws = spark.createDataFrame(
        [(sh, s, first, n, sizes[s], quota[s]) for sh, s, first, n in draw_shards(slots, shard_slots, seed)],
        "shard int, sid int, first long, count long, size long, quota long")
    slots_df = through_table(draws.repartition("shard").mapInPandas(
        _slots(block, seed), "shard int, slot long, sid int, block long, take long"), "mix-slots")

    buckets = max(1, -(-sum(int(r.rows) for r in stats) // bucket_rows))
    d = (sized.join(F.broadcast(sources.select("sid", F.col("source").alias("name"))),
                    F.col("source").eqNullSafe(F.col("name")))
         .select("id", "size", "sid", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(buckets)).alias("bucket")))
    alike = d.groupBy("sid", "bucket", "id", "size").agg(F.count(F.lit(1)).alias("copies"))
    before = (alike.groupBy("sid", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
              .select("sid", "bucket", (F.sum("words").over(
                  Window.partitionBy("sid").orderBy("bucket")) - F.col("words")).alias("start")))
    inside = Window.partitionBy("sid", "bucket").orderBy("id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = (alike.filter("size > 0").withColumn("upto", F.sum(F.col("size") * F.col("copies")).over(inside))
              .join(before, ["sid", "bucket"])
              .withColumn("back", F.explode(F.sequence(F.col("copies"), F.lit(1), F.lit(-1))))
              .select("id", "size", "sid", (F.col("start") + F.col("upto") - F.col("size") * F.col("back")).alias("off")))
    first, last = F.expr(f"off div {block}"), F.expr(f"(off + size - 1) div {block}")
    pieces = (placed.withColumn("block", F.explode(F.sequence(first, last)))
              .withColumn("begin", F.greatest("off", F.col("block") * block) - F.col("block") * block)
              .withColumn("end", F.least(F.col("off") + F.col("size"), (F.col("block") + 1) * block)
                          - F.col("block") * block))
    empty = d.filter("size = 0").select("id", "size", "sid")
    return {"sources": sources, "slots": slots_df, "pieces": pieces, "empty": empty}


def mix_sources(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, size, source_size, target, taken."""
    plan = mix_plan(docs, id_col, **options)
    got = (plan["pieces"].join(plan["slots"].select("sid", "block", "take").hint("merge"), ["sid", "block"], "left")
           .withColumn("words", F.greatest(F.least("end", "take") - F.col("begin"), F.lit(0)))
           .withColumn("words", F.when(F.col("take").isNull(), F.lit(0)).otherwise(F.col("words"))))
    per_doc = (got.groupBy("sid", "off", "id", "size").agg(F.sum("words").alias("taken")).drop("off")
               .unionByName(plan["empty"].withColumn("taken", F.lit(0).cast("long"))))
    return (per_doc.join(F.broadcast(plan["sources"].select("sid", "source_size", "target")), "sid")
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "taken"))

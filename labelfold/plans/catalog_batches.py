"""Registered queries of bounded summaries, block orders and committed batches, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dictionary import make_dictionary
from ..operators import analysis as an
from ..operators import block_order as bo
from ..operators import runs as rn
from ..operators.frame import EvalFrame
from ..session import read_table, scratch_path
from ..sources import committed as cm
from ..sources import corpus_io as io
from . import bindings as B
from .catalog import D_SQL, H_SQL, ORACLE, register


@register("top_label_combinations_bounded", ORACLE["top_label_combinations"])
def q_top_label_combinations_bounded(spark, sf):
    """At most 12 label sets held in a task, though more occur."""
    return an.label_combinations(B.frame_l(spark, sf), 0.5, "gt", 10, counters=12)


@register("embedding_sign_sets",
          "WITH g AS (SELECT array_to_string(list_transform(embedding, lambda x: CAST(CAST(x > 0 AS INTEGER) AS VARCHAR)), ',') "
          "AS vector, count(*) AS count FROM embeddings GROUP BY 1) SELECT row_number() OVER (ORDER BY count DESC, vector DESC) "
          "AS rank, vector, CAST(count AS BIGINT) AS count, CAST(count AS DOUBLE) / (SELECT CAST(sum(count) AS DOUBLE) FROM g) "
          "* 100.0::DOUBLE AS percentage FROM g ORDER BY 1 LIMIT 10")
def q_embedding_sign_sets(spark, sf):
    """Which components are positive, as a label set: one label a component, and nearly all sets differ."""
    emb = read_table(spark, sf, "embeddings")
    k = B.feature_dim(emb, "embedding")
    bits = F.expr("transform(embedding, x -> CAST(x > 0 AS INT))")
    ef = EvalFrame(emb.select("vec_id", bits.alias("y_true")), ("vec_id",), make_dictionary([f"c{i}" for i in range(k)]))
    return an.label_combinations(ef, truth=True, counters=1024).drop("labels")


SIDE = 16


def _hash_sql(*parts: str) -> str:
    text = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5(concat_ws(':', {text})), 1, 8)) AS BIGINT)"


def _blocks_sql(seed: int, epoch: int) -> str:
    """Every half step as a CTE of its own."""
    steps = [f"s0 AS (SELECT *, block // {SIDE} AS d0, block % {SIDE} AS d1 FROM b)"]
    for i in range(bo.HALF_STEPS):
        a, b = i % 2, 1 - i % 2
        steps.append(f"s{i + 1} AS (SELECT doc_id, split, block, (d{a} + {_hash_sql(seed, epoch, i, f'd{b}')}) % {SIDE} AS d{a}, d{b} FROM s{i})")
    return (f"WITH {D_SQL}, b AS (SELECT doc_id, split, {_hash_sql('doc_id', seed)} % {SIDE * SIDE} AS block FROM d), "
            + ", ".join(steps) + f" SELECT doc_id, split, block, CAST(d0 * {SIDE} + d1 AS BIGINT) AS place, "
            f"{_hash_sql('doc_id', seed, epoch)} AS shuffle_key FROM s{bo.HALF_STEPS}")


@register("shuffle_blocks", _blocks_sql(42, 3))
def q_shuffle_blocks(spark, sf):
    d = B.frame_d(spark, sf).select("doc_id", "split")
    return bo.shuffle_blocks(d, "doc_id", SIDE, seed=42, epoch=3, portable=True)


BATCHES = 3


@register("committed_run_log",
          f"WITH {H_SQL} SELECT run_id, step, metric, value FROM h WHERE metric IN ('eval_f1', 'eval_loss')")
def q_committed_run_log(spark, sf):
    """The run log in batches: one written twice, one whose other try was never committed."""
    path, log = scratch_path(spark, "run-batches"), B.frame_h(spark, sf).select("run_id", "step", "metric", "value")
    for batch in (1, 0, 2, 1):
        rn.append_run_batch(log.filter(F.col("step") % BATCHES == batch), path, batch)
    cm.write_attempt(log.filter(F.col("step") % BATCHES == 0), path, 0)
    return rn.read_run_batches(spark, path, ["eval_f1", "eval_loss"])


@register("committed_corpus",
          f"WITH {D_SQL} SELECT doc_id, split, quality, toxic, CAST(doc_id % {BATCHES} AS BIGINT) AS batch FROM d")
def q_committed_corpus(spark, sf):
    """The labelled corpus in batches under their splits; a failed try is removed, a repeated one replaced."""
    path, d = scratch_path(spark, "corpus-batches"), B.frame_d(spark, sf).select("doc_id", "split", "quality", "toxic")
    cm.write_attempt(d.filter(F.col("doc_id") % BATCHES == 1), path, 1, ("split",))
    for batch in (0, 2, 1, 0):
        io.append_labeled(d.filter(F.col("doc_id") % BATCHES == batch), path, batch)
    cm.remove_stale(spark, path)
    return cm.read_committed(spark, path, "doc_id long, split string, quality int, toxic int")

"""Registered queries of operators over growing inputs, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import incremental as inc
from ..operators import runs as rn
from ..session import scratch_path, stream_table
from ..streaming import early_stopping as es
from . import bindings as B
from .catalog import ORACLE, _early_stop_sql, register

BATCHES = 4


def _recorded(spark, sf) -> str:
    """Frame U recorded in four batches of users, out of order and one of them twice."""
    store, u = scratch_path(spark, "statistics-store"), B.frame_u(spark, sf)
    for batch in (2, 0, 3, 2, 1):
        inc.record_batch(u.filter(F.col("user_id") % BATCHES == batch), batch, store, B.u_dictionary())
    return store


@register("incremental_statistics", ORACLE["events_dataset_statistics"])
def q_incremental_statistics(spark, sf):
    return inc.merged_statistics(spark, _recorded(spark, sf), B.u_dictionary())


@register("incremental_class_weights", ORACLE["class_weights_balanced"])
def q_incremental_class_weights(spark, sf):
    return inc.merged_class_weights(spark, _recorded(spark, sf), B.u_dictionary(), "balanced", splits=None)


@register("early_stop_stream",
          "SELECT run_id, stop_position, best_position, best_value FROM ("
          + _early_stop_sql("eval_f1", rn.DEFAULT_PATIENCE, rn.DEFAULT_MIN_DELTA) + ") WHERE stopped = 1")
def q_early_stop_stream(spark, sf):
    """The run log as a stream of event records; every run that stops is told once."""
    stream = stream_table(spark, sf, "events")
    kinds = F.create_map(*[F.lit(x) for kv in B.RUN_METRICS.items() for x in kv])
    log = stream.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("step"),
                        kinds[F.col("event_type")].alias("metric"), "value")
    sink = scratch_path(spark, "watch-sink")
    es.watch_runs(log, sink, scratch_path(spark, "watch-ckpt"), "eval_f1").awaitTermination()
    return es.stops(spark, sink).select("run_id", "stop_position", "best_position", "best_value")

"""Run-log analysis over many runs and many steps.

Run log (long form): run_id, step, metric, value (+ any order column).

best_metric / best_checkpoint   one aggregate per run (max_by with the
                                first-on-ties key) plus one salted join of that
                                per-run row to count the position
early_stop                      an order-dependent fold, made associative:
                                the state after a row is the counter c in
                                0..P-1 (the best is the row c steps back) with
                                the best value it implies, so each row is a
                                P-entry transition table and
                                tables compose; chunks of consecutive rows are
                                composed in bounded groups (see ordering.py)
training_curves                 pivot of a fixed metric list per (run, step)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sqltext as X
from .ordering import chunked_fold, global_index
from ..sources.committed import append_batch, read_committed

# Default early-stopping parameters of the reference trainer.
DEFAULT_PATIENCE = 3
DEFAULT_MIN_DELTA = 0.001
METRIC_MODES = {"eval_loss": "min", "eval_f1": "max", "eval_accuracy": "max"}
FALLBACK_METRIC = "eval_f1"  # unknown names fall back to macro F1


# --- F1 ----------------------------------------------------------------------------

def append_run_log(log: DataFrame, path: str) -> None:
    """append (run_id, step, metric, value), sorted by run inside each file so
    that a run's reader skips most row groups (no folder per run)."""
    (log.select("run_id", "step", "metric", F.col("value").cast("double"))
     .sortWithinPartitions("run_id", "step").write.mode("append").parquet(path))


def read_run_log(spark, path: str, metrics: list | None = None) -> DataFrame:
    """read back; metric names outside ``metrics`` are ignored."""
    log = spark.read.parquet(path)
    return log if metrics is None else log.filter(F.col("metric").isin(list(metrics)))


RUN_LOG = "run_id long, step long, metric string, value double"


def append_run_batch(log: DataFrame, path: str, batch: int) -> None:
    """append a batch of records that is there whole or not at all, and once however often it is
    written (``sources.committed``)."""
    rows = log.select("run_id", "step", "metric", F.col("value").cast("double").alias("value"))
    append_batch(rows.sortWithinPartitions("run_id", "step"), path, batch)


def read_run_batches(spark, path: str, metrics: list | None = None) -> DataFrame:
    """the records of all committed batches."""
    log = read_committed(spark, path, RUN_LOG).drop("batch")
    return log if metrics is None else log.filter(F.col("metric").isin(list(metrics)))


# --- F2, F4 ------------------------------------------------------------------------

SALTS = 32  # parts a run's rows are dealt into where they meet the run's best row


def _value(col: str = "value") -> Column:
    """The value, null when it is NaN: a missing value never improves anything."""
    v = F.col(col).cast("double")
    return F.when(~F.isnan(v), v)


def best_metric(log: DataFrame, metric: str, mode: str = "max", run: str = "run_id",
                order: str = "step") -> DataFrame:
    """per run the best value, its step and its position in the metric's
    list (0-based); the first of equal values wins.  Missing values (null,
    NaN) count as positions but are never the best; a run without any value
    has null results."""
    if mode not in ("max", "min"):
        raise ValueError("mode must be 'max' or 'min'")
    s = log.filter(F.col("metric") == metric).select(run, order, _value().alias("value"))
    rec = F.when(F.col("value").isNotNull(), F.struct(F.col("value"), F.col(order).alias("best_step")))
    key = F.when(F.col("value").isNotNull(), F.struct(F.col("value") if mode == "max" else -F.col("value"),
                                                      -F.col(order)))
    per_run = (s.groupBy(run).agg(F.max_by(rec, key).alias("b"), F.count(F.lit(1)).alias("n_values"))
               .select(run, F.col("b.value").alias("best_value"), F.col("b.best_step").alias("best_step"),
                       "n_values"))
    # a run's rows are dealt into SALTS parts, so a hot run meets its one row in as many tasks;
    # each part counts its rows before the best step, and the parts are added up
    salt = F.pmod(F.xxhash64(run, order), F.lit(SALTS))
    dealt = per_run.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    parts = (s.withColumn("salt", salt).groupBy(run, "salt", order).agg(F.count(F.lit(1)).alias("n"))
             .join(dealt, [run, "salt"]).groupBy(run, "salt").agg(
                 F.max("best_value").alias("best_value"), F.max("best_step").alias("best_step"),
                 F.sum(F.when(F.col(order) < F.col("best_step"), F.col("n")).otherwise(0)).alias("before"),
                 F.max("n_values").alias("n_values")))
    return (parts.groupBy(run).agg(
        F.max("best_value").alias("best_value"), F.max("best_step").alias("best_step"),
        F.sum("before").alias("before"), F.max("n_values").alias("n_values"))
        .select(run, F.lit(metric).alias("metric"), "best_value", "best_step",
                F.when(F.col("best_step").isNotNull(), F.col("before")).cast("long").alias("best_position"),
                F.col("n_values").cast("long").alias("n_values")))


def best_checkpoint(log: DataFrame, metric: str = "eval_f1", run: str = "run_id",
                    order: str = "step") -> DataFrame:
    """best evaluation per run by strict improvement; eval_loss is
    minimised, eval_f1 / eval_accuracy maximised, other names use eval_f1."""
    name = metric if metric in METRIC_MODES else FALLBACK_METRIC
    return best_metric(log, name, METRIC_MODES[name], run, order)


# --- F3 ------------------------------------------------------------------------------

STOP = -1      # absorbing state: training stopped
UNREACHED = -2  # a counter larger than the rows seen so far


def _entry(state, stop=None, best=None) -> Column:
    """One table entry: next counter, stop row, best value so far."""
    return F.struct((F.lit(state) if isinstance(state, int) else state).alias("state"),
                    (F.lit(None) if stop is None else stop).cast("long").alias("stop"),
                    (F.lit(None) if best is None else best).cast("double").alias("best"))


def _table_type(p: int):
    return F.array(*[_entry(s) for s in range(p)])


def _compose(acc: Column, x: Column) -> Column:
    """acc then x: entries already stopped stay; others continue through x."""
    return F.transform(acc, lambda e: F.when(e["state"] < 0, e).otherwise(
        F.element_at(x, e["state"] + 1)))


def early_stop(log: DataFrame, metric: str | None = None, patience: int = DEFAULT_PATIENCE,
               min_delta: float = DEFAULT_MIN_DELTA, mode: str = "max", run: str = "run_id",
               order: list | None = None, chunk: int = 4096) -> DataFrame:
    """per run, where training would stop.

    Reference semantics: the first value is the best; a later value improves
    only if it beats the best by more than ``min_delta``; otherwise a counter
    grows and training stops when it reaches ``patience``.

    Output: run_id, n_steps, stopped (0/1), stop_position, best_position,
    best_value (positions 0-based in the run's order).
    """
    order = order or ["step"]
    s = log if metric is None else log.filter(F.col("metric") == metric)
    s = s.select(run, *order, _value().alias("value"))
    idx = global_index(s, [run] + order)
    starts = idx.groupBy(run).agg(F.min("gidx").alias("start"), F.max("gidx").alias("last"),
                                  F.count(F.lit(1)).alias("n_steps"))

    # lags 1..P from a halo: the last P rows of every chunk are repeated into
    # the next chunk, so a window per (run, chunk) sees them (groups <= C + P)
    p = patience
    chunk_of = F.floor(F.col("gidx") / F.lit(float(chunk))).cast("long")
    own = idx.withColumn("_chunk", chunk_of).withColumn("_halo", F.lit(False))
    halo = (idx.filter(F.col("gidx") % chunk >= chunk - p)
            .withColumn("_chunk", chunk_of + 1).withColumn("_halo", F.lit(True)))
    w = Window.partitionBy(run, "_chunk").orderBy("gidx")
    lagged = own.unionByName(halo).select(
        run, "gidx", "value", "_halo",
        *[F.lag("value", c + 1).over(w).alias(f"_lag{c}") for c in range(p)],
        *[F.lag("gidx", c + 1).over(w).isNotNull().alias(f"_has{c}") for c in range(p)],
        F.lag(F.col(run), 1).over(w).alias("_lrun0"))
    lagged = lagged.filter(~F.col("_halo"))

    def entry(c: int) -> Column:
        best, value = F.col(f"_lag{c}"), F.col("value")
        beats = (value > best + F.lit(float(min_delta)) if mode == "max"
                 else value < best - F.lit(float(min_delta)))
        improved = value.isNotNull() & (best.isNull() | beats)
        nxt = (F.when(improved, _entry(0, best=value))
               .when(F.lit(c + 1 >= p), _entry(STOP, F.col("gidx"), best))
               .otherwise(_entry(c + 1, best=best)))
        return F.when(F.col(f"_has{c}"), nxt).otherwise(_entry(UNREACHED))

    reset = F.array(*[_entry(0, best=F.col("value")) for _ in range(p)])
    # the window is per (run, chunk): a row without a previous row is a run start
    first_row = F.col("_lrun0").isNull()
    table = F.when(first_row, reset).otherwise(F.array(*[entry(c) for c in range(p)]))
    rows = lagged.select(run, "gidx", "value", table.alias("t"))
    # the index is checkpointed, so its row count is a cheap job; it bounds
    # the fold's levels (one level per factor of ``chunk`` rows)
    folded = chunked_fold(rows, [run], "gidx", "t", _table_type(p), _compose, chunk,
                          max_rows=idx.count())
    res = folded.join(starts, run).select(
        run, "start", "last", "n_steps", F.col("folded")[0].alias("e"))
    stopped = F.col("e.state") == STOP
    best_g = F.when(stopped, F.col("e.stop") - F.lit(p)).otherwise(F.col("last") - F.col("e.state"))
    return res.select(
        run, F.col("n_steps").cast("long").alias("n_steps"), stopped.cast("int").alias("stopped"),
        F.when(stopped, F.col("e.stop") - F.col("start")).alias("stop_position"),
        (best_g - F.col("start")).alias("best_position"), F.col("e.best").alias("best_value"))


# --- F5 ------------------------------------------------------------------------------

CURVE_METRICS = ("train_loss", "eval_loss", "eval_f1", "eval_accuracy", "learning_rate",
                 "macro_f1", "exact_match_accuracy", "hamming_loss", "macro_auc")


def training_curves(log: DataFrame, metrics=CURVE_METRICS, run: str = "run_id",
                    order: str = "step", nullable=("macro_auc",)) -> DataFrame:
    """the series behind the training plots, one row per (run, step) and
    one column per metric; a missing metric is 0 except the nullable ones.

    A pivot over a fixed metric list written as conditional aggregates: one
    partial+final aggregate on (run, step) (``pivot`` would aggregate on
    (run, step, metric) first, a second shuffle), and ``max`` keeps the
    result deterministic if a metric is logged twice at one step."""
    aggs = []
    for m in metrics:
        v = f"max(CASE WHEN metric = {X.lit(m)} THEN value END)"
        aggs.append(F.expr(v if m in nullable else f"coalesce({v}, 0.0D)").alias(m))
    return log.groupBy(run, order).agg(*aggs)


__all__ = ["append_run_log", "read_run_log", "best_metric", "best_checkpoint", "early_stop",
           "training_curves"]

"""F3 live: training runs are watched while they train, and a run's stop is told once.

The batch operator (``operators.runs.early_stop``) folds a finished log.  Here records of
(run, step, metric, value) arrive in micro-batches, out of order and late, and the state
of a run is the fold so far (best value, counter, positions) with the records that may
still be overtaken: those less than ``lateness`` steps behind the newest step of the run.
What lies further back is folded in the order of steps, with the batch operator's rules,
so a log whose records come at most ``lateness`` steps late stops where the batch operator
stops it.  Records of other metrics only move the run's newest step on (a last one, at
least ``lateness`` steps on, closes a run).  A record that comes later than that is counted
and not folded; after the stop a run's state is a few numbers.

A task holds the state of one run at a time and its records of the micro-batch, whose size
the source's rate limit bounds.  A replayed micro-batch writes its folder again, so a
restart tells no stop twice and loses none.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from ..operators.runs import DEFAULT_MIN_DELTA, DEFAULT_PATIENCE

STATE = ("newest long, folded long, n long, best double, best_at long, counter int, stopped boolean, late long, "
         "steps array<long>, vals array<double>")
OUT = "run_id long, stop_step long, stop_position long, best_position long, best_value double, n_late long"


def fold_value(best, counter: int, value, mode: str, min_delta: float) -> tuple:
    """(best, counter, whether it improved) after one more value; missing values never improve."""
    beats = value is not None and (best is None or (
        value > best + min_delta if mode == "max" else value < best - min_delta))
    return (value, 0, True) if beats else (best, counter + 1, False)


def _watch(metric: str, patience: int, min_delta: float, mode: str, lateness: int):
    import pandas as pd

    def fn(key, pdfs, state):
        newest, folded, n, best, best_at, counter, stopped, late, steps, vals = (
            state.get if state.exists else (None, None, 0, None, 0, 0, False, 0, [], []))
        waiting = list(zip(steps or [], vals or []))
        for pdf in pdfs:
            for step, name, value in zip(pdf["step"], pdf["metric"], pdf["value"]):
                step = int(step)
                newest = step if newest is None else max(newest, step)
                if name != metric:
                    continue
                if folded is not None and step <= folded:
                    late += 1
                elif not stopped:
                    waiting.append((step, None if value is None or math.isnan(value) else float(value)))
        limit, told = newest - lateness, None
        folded = limit if folded is None else max(folded, limit)
        ready = sorted((x for x in waiting if x[0] <= folded), key=lambda x: x[0])
        waiting = [x for x in waiting if x[0] > folded]
        for step, value in ready:
            if n == 0:
                best, counter = value, 0
            else:
                best, counter, improved = fold_value(best, counter, value, mode, min_delta)
                best_at = n if improved else best_at
            n += 1
            if counter >= patience:
                told, stopped, waiting = (step, n - 1, best_at, best), True, []
                break
        state.update((newest, folded, n, best, best_at, counter, stopped, late, [s for s, _ in waiting], [v for _, v in waiting]))
        if told:
            yield pd.DataFrame({"run_id": [key[0]], "stop_step": [told[0]], "stop_position": [told[1]],
                                "best_position": [told[2]], "best_value": pd.array([told[3]], dtype="Float64"), "n_late": [late]})
    return fn


def watch_runs(stream: DataFrame, sink_path: str, checkpoint: str, metric: str, patience: int = DEFAULT_PATIENCE,
               min_delta: float = DEFAULT_MIN_DELTA, mode: str = "max", lateness: int = 0):
    """Start the watch over (run_id, step, metric, value); every stop is one row under ``sink_path``."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    if patience < 1 or lateness < 0 or mode not in ("max", "min"):
        raise ValueError("patience is at least 1, lateness at least 0, the mode 'max' or 'min'")
    out = stream.select("run_id", "step", "metric", "value").groupBy("run_id").applyInPandasWithState(
        _watch(metric, patience, min_delta, mode, lateness), OUT, STATE, "update", GroupStateTimeout.NoTimeout)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")

    return (out.writeStream.outputMode("update").foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stops(spark: SparkSession, sink_path: str) -> DataFrame:
    """The stops told so far, one row a run."""
    return spark.read.schema(OUT + ", batch long").parquet(sink_path).drop("batch")

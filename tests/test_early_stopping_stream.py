"""Live early stopping equals the batch fold on shuffled micro-batches and survives a restart."""

import random

import pytest

from labelfold.operators import runs as rn
from labelfold.session import scratch_path
from labelfold.streaming import early_stopping as es

SCHEMA = "run_id long, step long, metric string, value double"


def logs(rng, n_runs=12, n=60):
    """Runs with plateaus, missing values and runs that never stop."""
    rows = []
    for run in range(n_runs):
        best = 0.0
        for step in range(n if run else 5):
            best += rng.choice([0.0, 0.0, 0.02, 0.0005]) if run % 4 else 0.05
            value = rng.choice([None, float("nan"), best, best - 0.1, best]) if run % 3 else best
            rows.append((run, step, "eval_f1", value))
            rows.append((run, step, "train_loss", 1.0))
    return rows


def shuffled(rng, rows, lateness):
    """Rows in an order in which none comes more than ``lateness`` steps behind the newest of its run."""
    return sorted(rows, key=lambda r: r[1] + rng.random() * (lateness + 0.5))


def play(spark, batches, src, sink, ckpt, **options):
    for i, rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{src}/part={i}")
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    q = es.watch_runs(stream, sink, ckpt, "eval_f1", **options)
    q.awaitTermination()
    return q


@pytest.mark.parametrize("lateness", [0, 7])
def test_shuffled_micro_batches_equal_the_batch_fold(spark, lateness):
    rng = random.Random(lateness)
    rows = logs(rng)
    order = shuffled(rng, rows, lateness) if lateness else sorted(rows, key=lambda r: r[1])
    cuts = sorted(rng.sample(range(1, len(order)), 3)) if lateness else [300, 700]
    if not lateness:  # whole steps a batch
        cuts = [next(i for i in range(c, len(order)) if order[i][1] != order[i - 1][1]) for c in cuts]
    parts = [order[a:b] for a, b in zip([0, *cuts], [*cuts, len(order)])]
    parts.append([(run, 1000, "run_end", 0.0) for run in range(12)])
    src, sink, ckpt = (scratch_path(spark, f"watch-{x}") for x in ("src", "sink", "ckpt"))
    # stopped after two batches and started again from its checkpoint
    play(spark, list(enumerate(parts))[:2], src, sink, ckpt, lateness=lateness)
    play(spark, list(enumerate(parts))[2:], src, sink, ckpt, lateness=lateness)
    got = {r.run_id: (r.stop_position, r.best_position, r.best_value) for r in es.stops(spark, sink).collect()}
    assert es.stops(spark, sink).count() == len(got)  # told once
    batch = rn.early_stop(spark.createDataFrame(rows, SCHEMA), "eval_f1").filter("stopped = 1").collect()
    assert got == {r.run_id: (r.stop_position, r.best_position, r.best_value) for r in batch} and 3 < len(got) < 12


def test_what_comes_too_late_is_counted(spark):
    src, sink, ckpt = (scratch_path(spark, f"late-{x}") for x in ("src", "sink", "ckpt"))
    flat = [(1, s, "eval_f1", 0.5) for s in (10, 11, 12)]
    play(spark, [(0, flat), (1, [(1, 9, "eval_f1", 0.9)]), (2, [(1, 13, "eval_f1", 0.5), (1, 14, "eval_f1", 0.5)])],
         src, sink, ckpt, lateness=0, patience=3)
    assert [tuple(r) for r in es.stops(spark, sink).collect()] == [(1, 13, 3, 0, 0.5, 1)]
    with pytest.raises(ValueError):
        es.watch_runs(None, sink, ckpt, "m", lateness=-1)

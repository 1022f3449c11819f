"""Run-log operators: early stopping (chunked fold), best metric, curves."""

import random

import pytest
from pyspark.sql import functions as F

from labelfold.operators import runs as rn


def brute_early_stop(values, patience, delta, mode="max"):
    best, best_pos, cnt = values[0], 0, 0
    for i in range(1, len(values)):
        v = values[i]
        better = v > best + delta if mode == "max" else v < best - delta
        if better:
            best, best_pos, cnt = v, i, 0
        else:
            cnt += 1
            if cnt >= patience:
                return 1, i, best_pos, best
    return 0, None, best_pos, best


def log_frame(spark, series):
    rows = [(run, step, "m", float(v)) for run, vals in series.items() for step, v in enumerate(vals)]
    return spark.createDataFrame(rows, "run_id long, step long, metric string, value double")


def test_micro_early_stop(spark):
    log = log_frame(spark, {1: [0.50, 0.5005, 0.52, 0.519, 0.5205, 0.521]})
    r = rn.early_stop(log, "m", 3, 0.001, "max").collect()[0]
    assert (r["stopped"], r["stop_position"], r["best_position"], r["best_value"]) == (1, 5, 2, 0.52)


@pytest.mark.parametrize("chunk", [4, 16, 4096])
def test_chunked_fold_matches_brute_force(spark, chunk):
    rnd = random.Random(7)
    series = {}
    # one hot run holding most rows, many small runs, a single-row run
    series[0] = [rnd.random() + i * 0.002 for i in range(600)]
    for run in range(1, 40):
        series[run] = [rnd.random() for _ in range(rnd.randint(2, 30))]
    series[99] = [0.3]
    log = log_frame(spark, series)
    for mode in ("max", "min"):
        got = {r["run_id"]: r for r in rn.early_stop(log, "m", 3, 0.01, mode, chunk=chunk).collect()}
        for run, vals in series.items():
            stopped, stop, best_pos, best = brute_early_stop(vals, 3, 0.01, mode)
            g = got[run]
            assert (g["stopped"], g["stop_position"], g["best_position"]) == (stopped, stop, best_pos), (run, mode)
            assert g["best_value"] == best and g["n_steps"] == len(vals)


def test_best_metric_first_on_ties(spark):
    log = log_frame(spark, {1: [0.2, 0.9, 0.9, 0.1], 2: [0.5, 0.4, 0.4]})
    mx = {r["run_id"]: r for r in rn.best_metric(log, "m", "max").collect()}
    assert (mx[1]["best_value"], mx[1]["best_position"], mx[1]["best_step"]) == (0.9, 1, 1)
    mn = {r["run_id"]: r for r in rn.best_metric(log, "m", "min").collect()}
    assert (mn[2]["best_value"], mn[2]["best_position"]) == (0.4, 1)


def test_best_checkpoint_modes(spark):
    rows = [(1, 0, "eval_loss", 0.5), (1, 1, "eval_loss", 0.3), (1, 2, "eval_loss", 0.3),
            (1, 0, "eval_f1", 0.1), (1, 1, "eval_f1", 0.7)]
    log = spark.createDataFrame(rows, "run_id long, step long, metric string, value double")
    assert rn.best_checkpoint(log, "eval_loss").collect()[0]["best_position"] == 1
    unknown = rn.best_checkpoint(log, "something_else").collect()[0]
    assert unknown["metric"] == "eval_f1" and unknown["best_value"] == 0.7


def test_training_curves_fill(spark):
    rows = [(1, 0, "train_loss", 0.9), (1, 1, "eval_f1", 0.4)]
    log = spark.createDataFrame(rows, "run_id long, step long, metric string, value double")
    out = {r["step"]: r for r in rn.training_curves(log).collect()}
    assert out[0]["train_loss"] == 0.9 and out[0]["eval_f1"] == 0.0 and out[1]["eval_f1"] == 0.4


def test_run_log_round_trip(spark, tmp_path):
    log = log_frame(spark, {1: [0.1, 0.2], 2: [0.3]})
    path = str(tmp_path / "runs")
    rn.append_run_log(log, path)
    rn.append_run_log(log.filter(F.col("run_id") == 2), path)
    back = rn.read_run_log(spark, path, metrics=["m"])
    assert back.count() == 4


def test_global_index_contiguous(spark):
    from labelfold.operators.ordering import global_index
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") * 13 % 1000).alias("o"))
    idx = global_index(df.repartition(9), ["g", "o"]).orderBy("gidx").collect()
    assert [r["gidx"] for r in idx] == list(range(1000))
    keys = [(r["g"], r["o"]) for r in idx]
    assert keys == sorted(keys)

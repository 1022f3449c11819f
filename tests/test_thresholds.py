"""Exact best thresholds, and the counts that they share with AUC."""

import random

import pytest
from pyspark.sql import functions as F

from labelfold.functions.dictionary import make_dictionary
from labelfold.operators import auc as auc_ops
from labelfold.operators import thresholds as th
from labelfold.operators.frame import EvalFrame


def frame(spark, rows, names):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, y_true array<int>, score array<double>")
    return EvalFrame(df.repartition(3), ("id",), make_dictionary(names))


def brute(cells, op):
    """(threshold, f1, tp, fp) of the best candidate by counting every cell for every distinct score."""
    scores = sorted({p for _, p in cells if p is not None and p == p})
    best = None
    for i, s in enumerate(scores):
        t = s if op == "ge" else scores[i - 1] if i else float("-inf")
        hit = [y for y, p in cells if p is not None and p == p and (p >= t if op == "ge" else p > t)]
        tp, fp, fn = sum(hit), len(hit) - sum(hit), sum(y for y, _ in cells) - sum(hit)
        f1 = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
        if best is None or f1 > best[1]:
            best = (t, f1, tp, fp)
    return best


@pytest.mark.parametrize("op", ["ge", "gt"])
@pytest.mark.parametrize("buckets", [None, 1, 7])
def test_against_brute_force(spark, op, buckets):
    rng = random.Random(8)

    def score():  # a hot score with a third of the rows, some missing, some repeated
        return rng.choice([0.25, None, float("nan"), round(rng.random(), 2), rng.random(), 0.25])
    rows = [([int(rng.random() < 0.3), 0, 1, int(rng.random() < 0.5)], [score() for _ in range(3)] + [None]) for _ in range(900)]
    rows += [([1, 0, 1, 0], [0.25, 0.25, 0.25, None])] * 450
    got = {r.label_idx: r for r in th.best_thresholds(frame(spark, rows, list("abcd")), op, buckets=buckets).collect()}
    for i in range(3):
        want = brute([(y[i], s[i]) for y, s in rows], op)
        assert (got[i].threshold, got[i].f1, got[i].tp, got[i].fp) == want
        assert got[i].tp + got[i].fp + got[i].fn + got[i].tn == len(rows)
    assert got[1].f1 == 0.0 and got[3].threshold is None and got[3].tp == got[3].fp == 0
    assert got[3].fn + got[3].tn == len(rows)


def test_other_metrics_and_errors(spark):
    ef = frame(spark, [([1], [0.9]), ([0], [0.8]), ([1], [0.7]), ([0], [0.1])], ["a"])
    assert th.best_thresholds(ef, metric="precision").first().threshold == 0.9
    assert th.best_thresholds(ef, metric="recall").first().threshold == 0.1  # the first of equal values
    assert th.threshold_list(th.best_thresholds(ef), 2) == [0.7, 0.5]
    with pytest.raises(ValueError):
        th.best_thresholds(ef, "lt")
    assert th.best_thresholds(ef.with_df(ef.df.filter("false"))).collect() == []


@pytest.mark.parametrize("buckets", [1, 2, 3, 8, 33])
def test_buckets_follow_the_scores(spark, buckets):
    counts = spark.range(5000).select((F.col("id") % 2).cast("int").alias("label_idx"), F.pow(F.col("id") / 5000, F.lit(9)).alias("p"),
                                      F.lit(1).cast("long").alias("pos"), F.lit(1).cast("long").alias("neg"))
    rows = auc_ops.with_buckets(counts, buckets).groupBy("label_idx", "bucket").agg(
        F.min("p").alias("lo"), F.max("p").alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("label_idx", "bucket").collect()
    for k in (0, 1):
        own = [r for r in rows if r.label_idx == k]
        assert [r.bucket for r in own] == list(range(buckets))
        assert all(a.hi < b.lo for a, b in zip(own, own[1:]))
        assert max(r.n for r in own) <= 2 * 2500 / buckets + 1


def test_the_input_is_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    ef = frame(spark, [([i % 2], [i / 1000]) for i in range(1000)], ["a"])
    for report in (lambda f: auc_ops.roc_auc(f, 5), th.best_thresholds):
        seen.value = 0
        report(ef.with_df(ef.df.mapInArrow(counted, ef.df.schema))).collect()
        assert seen.value == 1000

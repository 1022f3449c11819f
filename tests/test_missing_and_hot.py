"""Missing values follow one rule; hot keys never reach one task whole."""

import math

import pytest
from pyspark.sql import functions as F

from labelfold.functions.dictionary import make_dictionary
from labelfold.operators import analysis as an
from labelfold.operators import evaluate as ev
from labelfold.operators import runs as rn
from labelfold.operators.auc import roc_auc
from labelfold.operators.frame import EvalFrame
from labelfold.streaming.history import latest_lists, recent_history

NAN = float("nan")


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [(1, [1, 0], [0.9, NAN]), (2, [1, 1], [None, 0.8]), (3, [0, 0], [NAN, 0.1]), (4, [0, 1], [0.2, None])]
    return EvalFrame(spark.createDataFrame(rows, "id long, y_true array<int>, score array<double>"), ("id",),
                     make_dictionary(["a", "b"]))


def test_every_cell_is_counted_once(dirty):
    want = {"a": (1, 0, 1, 2), "b": (1, 0, 1, 2)}
    for table in (ev.per_label_metrics(dirty), an.per_label_report(dirty)):
        got = {r.label: (r.true_positive, r.false_positive, r.false_negative, r.true_negative) for r in table.collect()}
        assert got == want
    o = ev.overall_metrics(dirty).first()
    assert o.hamming_loss == 0.25 and o.exact_match_accuracy == 0.5
    s = {r.threshold: r for r in an.threshold_sweep(dirty).collect()}[0.5]
    assert s.hamming_loss == 0.25 and s.exact_match_accuracy == 0.5


def test_missing_scores_rank_lowest(dirty):
    # a: positives 0.9 and missing, negatives missing and 0.2
    assert {r.label: r.auc for r in roc_auc(dirty).collect()}["a"] == (1 + 1 + 0.5 + 0) / 4


def test_combinations_and_histogram_with_missing_scores(spark, dirty):
    got = {r.vector: r["count"] for r in an.label_combinations(dirty).collect()}
    assert got == {"1,0": 1, "0,1": 1, "0,0": 2}
    rows = an.score_histogram(dirty, 4).collect()
    assert len(rows) == 8 and sum(r["count"] for r in rows) == 4
    none = dirty.with_df(dirty.df.withColumn("score", F.array(F.lit(None).cast("double"), F.col("score")[1])))
    rows = an.score_histogram(none, 4).collect()
    assert len(rows) == 8 and sum(r["count"] for r in rows if r.label == "a") == 0
    assert sum(r["count"] for r in an.score_histogram(dirty.with_df(dirty.df.limit(0)), 4).collect()) == 0


def test_runs_with_missing_values(spark):
    runs = {1: [0.5, NAN, 0.4, 0.4, 0.4], 2: [None, 0.1, 0.2, 0.3], 3: [NAN, None], 4: [0.1, NAN, 0.9, None, 0.2]}
    log = spark.createDataFrame([(r, i, "m", v) for r, vs in runs.items() for i, v in enumerate(vs)],
                                "run_id long, step long, metric string, value double")
    got = {r.run_id: (r.stopped, r.stop_position, r.best_position, r.best_value) for r in rn.early_stop(log, "m").collect()}
    assert got == {1: (1, 3, 0, 0.5), 2: (0, None, 3, 0.3), 3: (0, None, 0, None), 4: (0, None, 2, 0.9)}
    best = {r.run_id: (r.best_value, r.best_step, r.best_position, r.n_values) for r in rn.best_metric(log, "m").collect()}
    assert best == {1: (0.5, 0, 0, 5), 2: (0.3, 3, 3, 4), 3: (None, None, None, 2), 4: (0.9, 2, 2, 5)}
    assert {r.run_id: r.best_value for r in rn.best_metric(log, "m", "min").collect()}[1] == 0.4


@pytest.fixture
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot(spark, n=40_000):
    """Four of five rows on one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 5 < 4, 7).otherwise(F.col("id") % 100).cast("long").alias("run_id"),
        F.col("id").alias("step"), F.lit("m").alias("metric"), (F.col("id") % 1000).cast("double").alias("value"))


def largest_share(df, spark):
    """The largest share of the rows of the last shuffled stage that one partition holds."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_best_metric_deals_a_hot_run_out(spark, no_broadcast):
    text = rn.best_metric(hot(spark), "m")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(run_id" in text and "salt" in text
    salt = F.pmod(F.xxhash64("run_id", "step"), F.lit(rn.SALTS))
    assert largest_share(hot(spark).repartition(64, "run_id", salt), spark) < 0.2
    r = {x.run_id: x for x in rn.best_metric(hot(spark), "m").collect()}[7]
    assert (r.best_value, r.n_values) == (998.0, 32_000) or r.n_values >= 32_000


def test_history_cuts_a_hot_user_before_the_shuffle(spark, no_broadcast):
    e = hot(spark).select(F.col("run_id").alias("user_id"), F.col("step").alias("event_id"), F.col("value"),
                          F.when(F.col("step") % 999 == 0, "clear").otherwise("view").alias("kind"))
    df = recent_history(e, "user_id", ["event_id"], 10, clear="kind = 'clear'")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") >= 2  # partial before the exchange, final after it
    got = sorted(r.event_id for r in df.filter("user_id = 7").collect())
    steps = [r.event_id for r in e.filter("user_id = 7 AND kind = 'view'").collect()]
    last = max(r.event_id for r in e.filter("user_id = 7 AND kind = 'clear'").collect())
    assert got == sorted(s for s in sorted(steps)[-10:] if s > last)


def test_latest_lists_keep_old_versions_in_their_tasks(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id % 3 AS user_id", "id AS event_id", "id AS ts_us", "'view' AS event_type",
                                        "1.0D AS value", "1 AS rank", "id AS version")
    rows.write.parquet(str(tmp_path / "sink"))
    df = latest_lists(spark, str(tmp_path / "sink"))
    assert df._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
    assert sorted(r.event_id for r in df.collect()) == [1997, 1998, 1999]


def test_nan_is_not_above(spark):
    from labelfold.functions import sqltext as X
    df = spark.createDataFrame([(0.6,), (NAN,), (None,)], "p double")
    assert [r.a for r in df.select(F.expr(X.above("p", 0.5)).alias("a")).collect()] == [True, False, False]
    assert math.isnan(NAN)

"""Losses, scoring and class weights on the micro frame and the goldens."""

import math

import pytest
from pyspark.sql import functions as F

from labelfold.functions.dictionary import default_dictionary, make_dictionary
from labelfold.operators import corpus as cp
from labelfold.operators import scoring as sc

A = pytest.approx


def with_logits(ef):
    z = F.transform("score", lambda p: F.log(p / (1 - p)))
    return ef.with_df(ef.df.withColumn("logit", z))


def test_losses(micro, spark):
    ef = with_logits(micro)
    rows = {r["kind"]: r for r in sc.loss_summary(ef, ["bce", "focal"]).collect()}
    assert rows["bce"]["mean"] == A(0.404285, abs=1e-6) and rows["bce"]["sum"] == A(7.277122, abs=1e-5)
    assert rows["focal"]["mean"] == A(0.118049, abs=1e-6) and rows["focal"]["sum"] == A(2.124875, abs=1e-5)
    pw = spark.createDataFrame([(0, 2.0), (1, 1.0), (2, 1.0)], "label_idx int, pos_weight double")
    w = sc.loss_summary(ef, ["weighted_bce"], pos_weights=pw).collect()[0]
    assert w["mean"] == A(0.422535, abs=1e-6) and w["sum"] == A(7.605626, abs=1e-5)
    assert sc.loss(ef, "bce", "mean").collect()[0]["loss"] == A(0.404285, abs=1e-6)
    assert sc.loss(ef, "bce", "none").count() == 18
    with pytest.raises(ValueError):
        sc.loss_cell("hinge", F.lit(0.0), F.lit(1))


def test_class_weights_micro(micro):
    wide = micro.df.select(*[F.col("y_true")[i].alias(n) for i, n in enumerate("abc")])
    d = make_dictionary(["a", "b", "c"])
    np_ = {r["label"]: r["pos_weight"] for r in cp.class_weights(wide, d, "neg_pos", drop_empty=True).collect()}
    assert np_ == {"a": 2.0, "b": 1.0}  # c has no positives: dropped
    assert {r["label"]: r["pos_weight"] for r in cp.class_weights(wide, d, "neg_pos").collect()}["c"] == 1.0
    split = wide.withColumn("split", F.when(F.col("a") == 1, "valid").otherwise("train"))
    assert {r["label"]: r["n_pos"] for r in cp.class_weights(split, d).collect()}["a"] == 0  # train rows only
    bal = {r["label"]: r["pos_weight"] for r in cp.class_weights(wide, d, "balanced").collect()}
    assert bal == {"a": 2.0, "b": 1.0, "c": 1.0}
    inv = {r["label"]: r["pos_weight"] for r in cp.class_weights(wide, d, "inverse_frequency").collect()}
    assert inv["c"] == A(2.999985, abs=1e-6) and inv["a"] == A(9.0e-6, rel=1e-3)
    one = {r["label"]: r["pos_weight"] for r in cp.class_weights(wide, d, "none").collect()}
    assert set(one.values()) == {1.0}


# Goldens: positive counts of the reference corpus ("all" split, 18742 rows) and
GOLD_COUNTS = [1993, 1681, 1421, 2154, 749, 1312, 1471, 703, 3929, 4674]
GOLD_WEIGHTS = [8.404, 10.149, 12.189, 7.701, 24.023, 13.285, 11.741, 25.66, 3.77, 3.01]
GOLD_N = 18742


def test_goldens_weights_and_percentages(spark):
    d = default_dictionary()
    cols = [(F.col("id") < c).cast("int").alias(n) for c, n in zip(GOLD_COUNTS, d.names)]
    df = spark.range(GOLD_N).select(*cols)
    w = [r["pos_weight"] for r in cp.class_weights(df, d, "neg_pos").orderBy("label_idx").collect()]
    assert w == GOLD_WEIGHTS
    dist = cp.label_distribution(df, d, by=None).orderBy("label_idx").collect()
    for r, c in zip(dist, GOLD_COUNTS):
        assert r["count"] == c and r["percentage"] == A(c / GOLD_N * 100)


def test_half_even_tie(spark):
    from labelfold.operators.corpus import half_even_ratio_sql
    r = spark.range(1).select(F.expr(half_even_ratio_sql("4001", "2000", 3)).alias("a"),
                              F.expr(half_even_ratio_sql("4003", "2000", 3)).alias("b")).collect()[0]
    assert r["a"] == 2.0 and r["b"] == 2.002


def test_score_batch_top_and_ge(spark):
    df = spark.createDataFrame([(1, [0.5, 0.9, 0.9]), (2, [0.1, 0.2, 0.3])], "id int, score array<double>")
    out = {r["id"]: r for r in sc.score_batch(df, ["x", "y", "z"], 0.5, "ge", sort_labels=True).collect()}
    assert out[1]["top"]["name"] == "y"  # first of the tied maxima
    assert [l["name"] for l in out[1]["labels"]] == ["y", "z", "x"]
    assert [l["predicted"] for l in out[1]["labels"]] == [True, True, True]  # 0.5 >= 0.5
    assert not any(l["predicted"] for l in out[2]["labels"])


def test_linear_head_matches_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    X = rng.normal(size=(20, 5))
    W = rng.normal(size=(3, 5))
    b = rng.normal(size=3)
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(20)], "id int, features array<double>")
    got = sc.probabilities(sc.linear_head(df, W.tolist(), b.tolist()), 3).orderBy("id").collect()
    ref = 1 / (1 + np.exp(-(X @ W.T + b)))
    for i, r in enumerate(got):
        assert r["score"] == A(ref[i].tolist(), abs=1e-12)
    assert not math.isnan(got[0]["logit"][0])


def test_weighted_cells_sum_to_summary_and_reject_duplicates(micro, spark):
    from labelfold.operators.frame import EvalFrame
    ef = EvalFrame(micro.df.withColumn("logit", F.expr("transform(score, p -> (p - 0.5D) * 6.0D)")),
                   micro.keys, micro.labels)
    pw = spark.createDataFrame([(0, 2.0), (2, 3.0)], "label_idx int, pos_weight double")
    cells = sc.loss(ef, "weighted_bce", "none", pos_weights=pw)
    total = cells.agg(F.sum("loss")).collect()[0][0]
    summ = sc.loss_summary(ef, ["weighted_bce"], pos_weights=pw).collect()[0]
    assert cells.count() == 18 and total == A(summ["sum"], abs=1e-5)
    dup = spark.createDataFrame([(0, 2.0), (0, 3.0)], "label_idx int, pos_weight double")
    with pytest.raises(ValueError):
        sc.loss_summary(ef, ["weighted_bce"], pos_weights=dup)


def test_losses_are_neither_cut_nor_capped(spark):
    """A confident right model keeps its tiny loss; huge logits neither overflow nor fail."""
    from labelfold.operators.frame import EvalFrame
    d = make_dictionary(["a", "b"])
    ef = lambda z, y: EvalFrame(spark.createDataFrame([(1, y, z)], "id long, y_true array<int>, logit array<double>"),
                                ("id",), d)
    r = sc.loss_summary(ef([30.0, -30.0], [1, 0]), ["bce"]).first()
    assert 0 < r["mean"] < 1e-9 and r["mean"] == A(math.log1p(math.exp(-30.0)), rel=1e-9)
    r = sc.loss_summary(ef([2e9, 5.0], [0, 1]), ["bce"]).first()
    assert r["sum"] == A(2e9, rel=1e-9)


def test_threshold_column(spark):
    df = spark.createDataFrame([(1, [0.4, 0.9], 0.3), (2, [0.4, 0.9], 0.5), (3, [0.4, float("nan")], 0.1)],
                               "id long, score array<double>, t double")
    got = {r.id: [x.predicted for x in r.labels] for r in sc.score_batch(df, ["a", "b"], "t").collect()}
    assert got == {1: [True, True], 2: [False, True], 3: [True, False]}


def test_linear_head_is_the_matrix_product(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [0.5, -1.0])], "id long, features array<double>")
    got = {r.id: r.logit for r in sc.linear_head(df, [[1.0, 0.0], [2.0, -1.0], [0.0, 0.0]], [0.0, 1.0, 5.0]).collect()}
    assert got == {1: [1.0, 1.0, 5.0], 2: None, 3: [0.5, 3.0, 5.0]}

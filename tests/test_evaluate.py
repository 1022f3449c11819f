"""Evaluation operators on the FIXTURES micro frame (hand-computed values)."""

import math

import pytest
from pyspark.sql import functions as F

from labelfold.operators import analysis as an
from labelfold.operators import auc as auc_ops
from labelfold.operators import evaluate as ev

A = pytest.approx


def by_label(df):
    return {r["label"]: r.asDict() for r in df.collect()}


def test_per_label_metrics_strict(micro):
    m = by_label(ev.per_label_metrics(micro, 0.5, "gt"))
    a, b, c = m["a"], m["b"], m["c"]
    assert (a["true_positive"], a["false_positive"], a["false_negative"], a["true_negative"]) == (2, 1, 0, 3)
    assert (b["true_positive"], b["false_positive"], b["false_negative"], b["true_negative"]) == (1, 0, 2, 3)
    assert (c["true_positive"], c["false_positive"], c["false_negative"], c["true_negative"]) == (0, 1, 0, 5)
    assert a["precision"] == A(2 / 3) and a["recall"] == 1 and a["f1"] == A(0.8)
    assert a["accuracy"] == A(5 / 6) and a["specificity"] == A(0.75)
    assert b["precision"] == 1 and b["recall"] == A(1 / 3) and b["f1"] == A(0.5)
    assert c["precision"] == 0 and c["recall"] == 0 and c["f1"] == 0  # zero_division=0
    assert c["specificity"] == A(5 / 6)


def test_ge_moves_tie(micro):
    m = by_label(ev.per_label_metrics(micro, 0.5, "ge"))
    assert (m["b"]["true_positive"], m["b"]["false_negative"]) == (2, 1)


def test_averages(micro):
    rows = {r["row_name"]: r for r in ev.averages(micro).collect()}
    assert (rows["micro avg"]["precision"], rows["micro avg"]["recall"], rows["micro avg"]["f1"]) == (
        A(0.6), A(0.6), A(0.6))
    assert rows["macro avg"]["precision"] == A(5 / 9) and rows["macro avg"]["f1"] == A(0.433333, abs=1e-6)
    assert rows["weighted avg"]["precision"] == A(0.866667, abs=1e-6)
    assert rows["weighted avg"]["f1"] == A(0.62)
    assert rows["samples avg"]["precision"] == A(0.5)
    assert rows["samples avg"]["recall"] == A(0.416667, abs=1e-6)
    assert rows["samples avg"]["f1"] == A(0.444444, abs=1e-6)


def test_overall_and_auc(micro):
    o = ev.overall_metrics(micro).collect()[0]
    assert o["exact_match_accuracy"] == A(0.5) and o["subset_accuracy"] == A(0.5)
    assert o["hamming_loss"] == A(4 / 18)
    assert o["macro_auc"] == A(0.777778, abs=1e-6)
    auc = {r["label"]: r["auc"] for r in auc_ops.roc_auc(micro).collect()}
    assert auc["a"] == A(1.0) and auc["b"] == A(0.833333, abs=1e-6) and auc["c"] is None


def test_auc_partition_count_invariant(micro):
    a1 = {r["label"]: r["auc"] for r in auc_ops.roc_auc(micro, partitions=1).collect()}
    a2 = {r["label"]: r["auc"] for r in auc_ops.roc_auc(micro, partitions=7).collect()}
    assert a1 == a2


def test_auc_clustered_scores_vs_brute_force(spark):
    """Scores packed into a tiny range with many ties (the case that makes a
    fixed score bucket hot) against the pairwise definition."""
    import numpy as np
    from labelfold.functions.dictionary import make_dictionary
    from labelfold.operators.frame import EvalFrame
    rng = np.random.default_rng(7)
    n = 400
    y = rng.integers(0, 2, size=(n, 2))
    p = np.where(rng.random((n, 2)) < 0.7, rng.integers(0, 5, size=(n, 2)) * 1e-7,
                 rng.random((n, 2)))
    rows = [(i, [int(a) for a in y[i]], [float(b) for b in p[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id long, y_true array<int>, score array<double>")
    ef = EvalFrame(df, ("row_id",), make_dictionary(["u", "v"]))
    got = {r["label_idx"]: r["auc"] for r in auc_ops.roc_auc(ef, partitions=5).collect()}
    for k in range(2):
        ps, ns = p[y[:, k] == 1, k], p[y[:, k] == 0, k]
        wins = (ps[:, None] > ns[None, :]).sum() + 0.5 * (ps[:, None] == ns[None, :]).sum()
        assert got[k] == A(wins / (len(ps) * len(ns)), abs=1e-12)


def test_sweep_and_best(micro):
    sw = {r["t_idx"]: r for r in an.threshold_sweep(micro).collect()}
    expect = {  # t: exact, macro P, macro R, macro F1, Hamming
        0: (0.333333, 0.333333, 0.666667, 0.440476, 0.388889),
        1: (0.5, 0.355556, 0.555556, 0.412698, 0.333333),
        2: (0.5, 0.466667, 0.555556, 0.457143, 0.277778),
        3: (0.666667, 0.555556, 0.555556, 0.533333, 0.166667),
        4: (0.5, 0.555556, 0.444444, 0.433333, 0.222222),
        5: (0.666667, 0.666667, 0.444444, 0.5, 0.111111),
        6: (0.5, 0.333333, 0.333333, 0.333333, 0.166667),
        7: (0.5, 0.333333, 0.166667, 0.222222, 0.222222),
        8: (0.333333, 0.0, 0.0, 0.0, 0.277778),
    }
    for j, (e, p, r, f, h) in expect.items():
        row = sw[j]
        got = (row["exact_match_accuracy"], row["macro_precision"], row["macro_recall"], row["macro_f1"],
               row["hamming_loss"])
        assert got == tuple(A(x, abs=1e-6) for x in (e, p, r, f, h)), j
    best = an.best_threshold(an.threshold_sweep(micro)).collect()[0]
    assert best["threshold"] == A(0.4)


def test_sweep_unsorted_duplicate_thresholds(micro):
    ts = [0.5, 0.1, 0.5]
    sw = {r["t_idx"]: r for r in an.threshold_sweep(micro, ts).collect()}
    assert sw[0]["macro_f1"] == sw[2]["macro_f1"] == A(0.433333, abs=1e-6)
    assert sw[1]["macro_f1"] == A(0.440476, abs=1e-6)


def test_hard_examples(micro):
    rows = an.hard_examples(micro, 3).orderBy("rank").collect()
    assert [r["row_id"] for r in rows] == [3, 4, 1]
    assert rows[0]["hardness"] == A(0.933333, abs=1e-6)
    assert rows[1]["predicted_labels"] == "a" and rows[0]["true_labels"] == "clean"


def test_combinations(micro):
    rows = an.label_combinations(micro).orderBy("rank").collect()
    assert [(r["labels"], r["count"]) for r in rows] == [("a", 3), ("b", 1), ("c", 1), ("clean", 1)]
    assert sum(r["percentage"] for r in rows) == A(100.0)
    truth = an.prediction_distribution(micro, truth=True).collect()[0]
    assert truth["avg_labels_per_sample"] == A(5 / 6) and truth["max_labels_per_sample"] == 2
    assert truth["samples_with_no_labels"] == 2 and truth["samples_with_multiple_labels"] == 1


def test_histogram(micro):
    h = an.score_histogram(micro, 4).filter(F.col("label") == "a").orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 2, 1, 2]
    assert h[0]["bin_lo"] == A(0.1) and h[-1]["bin_hi"] == A(0.9)
    total = an.score_histogram(micro, 50).agg(F.sum("count")).collect()[0][0]
    assert total == 6 * 3


def test_metrics_need_truth(micro):
    from dataclasses import replace
    with pytest.raises(ValueError):
        ev.counts_row(replace(micro, has_truth=False))


def test_repartition_invariance(micro):
    a = sorted(map(tuple, ev.per_label_metrics(micro).collect()))
    b = sorted(map(tuple, ev.per_label_metrics(micro.with_df(micro.df.repartition(5))).collect()))
    assert a == b


def test_invariants_on_lineitem(spark):
    from labelfold.plans import bindings as B
    from tests.conftest import SF_SMALL
    ef = B.frame_l(spark, SF_SMALL)
    n = ef.df.count()
    for r in ev.confusion(ef).collect():
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == n
    o = ev.overall_metrics(ef).collect()[0]
    assert o["hamming_loss"] <= 1 - o["exact_match_accuracy"] + 1e-12
    flipped = ef.with_df(ef.df.withColumn("score", F.transform("score", lambda p: 1 - p)))
    a1 = {r["label_idx"]: r["auc"] for r in auc_ops.roc_auc(ef).collect()}
    a2 = {r["label_idx"]: r["auc"] for r in auc_ops.roc_auc(flipped).collect()}
    for k in a1:
        assert a1[k] + a2[k] == A(1.0)
    hist = an.score_histogram(ef, 50).agg(F.sum("count")).collect()[0][0]
    assert hist == n * ef.k
    combos = an.label_combinations(ef, top=1 << ef.k).agg(F.sum("count")).collect()[0][0]
    assert combos == n
    assert not math.isnan(o["macro_auc"])


def test_auc_exact_with_huge_tied_counts(spark):
    """A score shared by ~1e11 cells (a third of the rows at 100 TB): the
    per-partition sums exceed 2**63 and must stay exact."""
    from decimal import Decimal
    groups = [(0, 0.1, 10**11, 3 * 10**11), (0, 0.5, 2 * 10**11, 10**11), (0, 0.9, 7, 5),
              (1, 0.2, 5 * 10**10, 9 * 10**10), (1, 0.3, 1, 10**11)]
    df = spark.createDataFrame(groups, "label_idx int, p double, pos long, neg long")
    halves = df.withColumn("pos", F.floor(F.col("pos") / 2)).unionByName(  # equal keys of two tasks are merged
        df.withColumn("pos", F.col("pos") - F.floor(F.col("pos") / 2)).withColumn("neg", F.lit(0).cast("long")))
    got = {r["label_idx"]: r for r in auc_ops.sums_of_cells(halves, [0.45, 0.25], partitions=2).collect()}
    assert (got[0]["tp"], got[0]["fp"]) == (2 * 10**11 + 7, 10**11 + 5) and got[1]["tp"] == 1
    for lab in (0, 1):
        rows = sorted((g for g in groups if g[0] == lab), key=lambda g: g[1])
        below, s2 = 0, 0
        for _, _, pos, neg in rows:
            s2 += pos * (2 * below + neg)
            below += neg
        assert got[lab]["s2"] == Decimal(s2)
        assert got[lab]["n_pos"] == sum(g[2] for g in rows) and got[lab]["n_neg"] == below


def test_label_names_survive_sql_text(spark):
    """Label names are embedded as SQL literals: quotes, backslashes and the
    default Korean names must come back unchanged."""
    from labelfold.functions.dictionary import make_dictionary
    from labelfold.operators.frame import EvalFrame
    names = ["it's", "back\\slash", "여성/가족"]
    df = spark.createDataFrame([(0, [1, 0, 1], [0.9, 0.1, 0.8]), (1, [0, 1, 0], [0.2, 0.7, 0.1])],
                               "row_id long, y_true array<int>, score array<double>")
    ef = EvalFrame(df, ("row_id",), make_dictionary(names))
    assert [r["label"] for r in ev.per_label_metrics(ef).orderBy("label_idx").collect()] == names
    combos = {r["labels"] for r in an.label_combinations(ef).collect()}
    assert combos == {"it's,여성/가족", "back\\slash"}
    assert {r["label"] for r in auc_ops.roc_auc(ef).collect()} == set(names)


@pytest.mark.parametrize("op", ["gt", "ge"])
def test_shared_scan_counts_equal_direct_counts(micro, spark, op):
    """overall_metrics / per_label_report take their counts from the AUC's
    table of sums; they must equal the direct one-row aggregate."""
    from labelfold.plans import bindings as B
    from tests.conftest import SF_SMALL
    for ef in (micro, B.frame_l(spark, SF_SMALL)):
        shared = ev.overall_metrics(ef, 0.5, op).drop("macro_auc", "auc_by_label").collect()[0].asDict()
        direct = ev.overall_metrics(ef, 0.5, op, with_auc=False).collect()[0].asDict()
        assert shared == direct
        cols = ["label_idx"] + ev.PER_LABEL_COLUMNS
        rep = sorted(tuple(r) for r in an.per_label_report(ef, 0.5, op).select(*cols).collect())
        plm = sorted(tuple(r) for r in ev.per_label_metrics(ef, 0.5, op).select(*cols).collect())
        assert rep == plm


def test_given_predictions_without_scores(micro):
    """A 0/1 prediction vector is evaluated as given; AUC is null."""
    pred = micro.with_df(micro.df.withColumn("y_pred", F.expr(
        "transform(score, p -> CAST(p > 0.5D AS INT))")))
    o = ev.overall_metrics(pred, pred_col="y_pred").collect()[0]
    d = ev.overall_metrics(micro, with_auc=False).collect()[0]
    assert o["macro_auc"] is None and all(o[c] == d[c] for c in d.asDict())
    a = sorted(map(tuple, ev.per_label_metrics(pred, pred_col="y_pred").collect()))
    b = sorted(map(tuple, ev.per_label_metrics(micro).collect()))
    assert a == b

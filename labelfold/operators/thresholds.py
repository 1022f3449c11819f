"""Exact best threshold per label, found from the scores themselves.

Every distinct score of a label is a candidate; the threshold sweep (E12) only looks
at a given grid.  The plan is a distributed prefix scan over the (label, score)
counts that AUC uses: the counts are written once, cut into buckets at sketched
quantiles, bucket totals give each bucket's offset (K x buckets rows), and a window
per (label, bucket) carries the positives and negatives below each score on.  With
the label's totals that is the confusion matrix at every candidate; the best of each
label is an aggregate with partial maxima.  No label and no score is one task's work:
a score that a third of all rows share is one row of the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sqltext as X
from .auc import truth_cells, with_buckets, written_counts
from .evaluate import metric_exprs
from .frame import EvalFrame

METRICS = ("f1", "precision", "recall", "accuracy")


def best_thresholds(ef: EvalFrame, op: str = "ge", metric: str = "f1", buckets: int | None = None) -> DataFrame:
    """(label_idx, label, threshold, precision, recall, f1, accuracy, tp, fp, fn, tn) of each label's best threshold.

    ``ge``: the threshold is the lowest score that is still predicted.  ``gt``: it is the next lower
    distinct score, minus infinity below the lowest.  Of equal values the lowest threshold wins; missing
    scores are predicted at none; a label without any score keeps a null threshold and predicts nothing."""
    ef.require_truth()
    if op not in ("gt", "ge") or metric not in METRICS:
        raise ValueError(f"op must be 'gt' or 'ge' and the metric one of {METRICS}, not {op!r}, {metric!r}")
    counts = with_buckets(written_counts(ef.df.select(X.inline_rows(truth_cells(ef)))), buckets)
    before = Window.partitionBy("label_idx").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    label = Window.partitionBy("label_idx")
    # K x buckets rows: what stands below each bucket, its predecessor's highest score, the label's totals
    offsets = counts.groupBy("label_idx", "bucket").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.max("p").alias("top")).select(
        "label_idx", "bucket", F.max("top").over(before).alias("under"),
        F.coalesce(F.sum("pos").over(before), F.lit(0)).alias("off_pos"),
        F.coalesce(F.sum("neg").over(before), F.lit(0)).alias("off_neg"),
        F.sum("pos").over(label).alias("all_pos"), F.sum("neg").over(label).alias("all_neg"))
    order = Window.partitionBy("label_idx", "bucket").orderBy("p")
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    at = (counts.withColumn("in_pos", F.coalesce(F.sum("pos").over(below), F.lit(0)))
          .withColumn("in_neg", F.coalesce(F.sum("neg").over(below), F.lit(0)))
          .withColumn("previous", F.lag("p").over(order))
          .join(F.broadcast(offsets), ["label_idx", "bucket"])
          .selectExpr("label_idx", "p", "coalesce(previous, under, CAST('-Infinity' AS DOUBLE)) AS previous",
                      "off_pos + in_pos AS fn", "off_neg + in_neg AS tn",
                      "all_pos - off_pos - in_pos AS tp", "all_neg - off_neg - in_neg AS fp"))
    m = metric_exprs("tp", "fp", "fn", "tn", n="(tp + fp + fn + tn)")
    # missing scores rank at minus infinity: counted, never a candidate
    scored = at.filter("p > CAST('-Infinity' AS DOUBLE)").selectExpr(
        "label_idx", "p", "previous" if op == "gt" else "p AS previous", f"{m[metric]} AS value", "tp", "fp", "fn", "tn")
    best = scored.groupBy("label_idx").agg(F.expr(
        "max_by(struct(previous AS threshold, tp, fp, fn, tn), struct(value, -p))").alias("b"))
    without = counts.groupBy("label_idx").agg(F.sum("pos").alias("fn"), F.sum("neg").alias("tn"))
    names = X.array_of([X.lit(n) for n in ef.names])
    return (without.join(F.broadcast(best), "label_idx", "left")
            .selectExpr("label_idx", "b.threshold", "coalesce(b.tp, 0) AS tp", "coalesce(b.fp, 0) AS fp",
                        "coalesce(b.fn, fn) AS fn", "coalesce(b.tn, tn) AS tn")
            .selectExpr("label_idx", f"{names}[label_idx] AS label", "threshold",
                        *[f"{m[c]} AS {c}" for c in ("precision", "recall", "f1", "accuracy")], "tp", "fp", "fn", "tn"))


def threshold_list(found: DataFrame, k: int, default: float = 0.5) -> list[float]:
    """The K thresholds as a list that ``binarize`` and the metrics take; ``default`` where none was found."""
    rows = {r["label_idx"]: r["threshold"] for r in found.select("label_idx", "threshold").limit(k).collect()}
    return [default if rows.get(i) is None else float(rows[i]) for i in range(k)]

"""Registered queries of the fits that run to their optimum, with their DuckDB SQL.

No SQL can name a fit's weights, so each query checks its own: a second computation, by
another path than the solver's, must find the gradient of the objective within
``GAP`` of zero at the fitted point.  Class weights and counts come from SQL.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import corpus as cp
from ..operators import features as ft
from ..operators import fit as fit_ops
from ..operators import solver
from ..session import scratch_path
from . import bindings as B
from .catalog import D_NAMES, D_SQL, V_LABEL_ROWS, V_NAMES, register

GAP, TEXT_REG, HEAD_REG = 1e-5, 0.01, 1e-3


def text_gradients(cells: DataFrame, truth: DataFrame, fit: solver.Fit, weights: list, reg: float) -> DataFrame:
    """(label_idx, gap): the largest gradient entry of each label's weighted objective at a fit, by
    joins over (doc_id, bucket, tfidf) cells and truth (doc_id, label_idx, y)."""
    spark = cells.sparkSession
    k = len(weights)
    at = np.nonzero(np.abs(fit.weights).max(axis=0))[0]  # the buckets of the training texts
    # one row a bucket, at most the model's size
    table = spark.createDataFrame(pd.DataFrame({"bucket": at, **{f"w{i}": fit.weights[i, at] for i in range(k)}}),
                                  "bucket long, " + ", ".join(f"w{i} double" for i in range(k)))
    head = spark.createDataFrame([(i, float(weights[i]), float(fit.intercepts[i])) for i in range(k)],
                                 "label_idx int, pw double, b double")
    z = cells.join(F.broadcast(table), "bucket").groupBy("doc_id").agg(
        F.array(*[F.sum(F.col("tfidf") * F.col(f"w{i}")) for i in range(k)]).alias("xw"))
    g = (truth.join(F.broadcast(head), "label_idx").join(z, "doc_id", "left")
         .withColumn("z", F.coalesce(F.get("xw", F.col("label_idx")), F.lit(0.0)) + F.col("b"))
         .withColumn("c", F.when(F.col("y") == 1, F.col("pw")).otherwise(F.lit(1.0)))
         .withColumn("g", F.expr("c * (1D / (1D + exp(-z)) - y)")).select("doc_id", "label_idx", "g", "c"))
    total = g.groupBy("label_idx").agg(F.sum("c").alias("total"), F.sum("g").alias("gb"))
    # a document's slopes side by side: its cells meet them once; equal ids add up as their rows would
    slopes = g.groupBy("doc_id").agg(*[F.sum(F.when(F.col("label_idx") == i, F.col("g"))).alias(f"g{i}") for i in range(k)])
    sums = (cells.join(slopes, "doc_id").groupBy("bucket")
            .agg(*[F.sum(F.col(f"g{i}") * F.col("tfidf")).alias(f"gw{i}") for i in range(k)])
            .join(F.broadcast(table), "bucket", "left"))
    entries = (sums.select(F.explode(F.array(*[F.struct(
        F.lit(i).alias("label_idx"), F.col(f"gw{i}").alias("gw"), F.col(f"w{i}").alias("w")) for i in range(k)])).alias("e"))
        .select("e.*").join(F.broadcast(total), "label_idx")
        .select("label_idx", F.abs(F.col("gw") / F.col("total") + reg * F.coalesce("w", F.lit(0.0))).alias("gap"))
        .unionByName(total.select("label_idx", F.abs(F.col("gb") / F.col("total")).alias("gap"))))
    return entries.groupBy("label_idx").agg(F.max("gap").alias("gap"))


@register("fit_text_labels",
          f"WITH {D_SQL}, n AS (SELECT count(*) AS n, sum(quality) AS q, sum(toxic) AS x FROM d WHERE split = 'train'), "
          "w AS (SELECT 0 AS label_idx, 'quality' AS label, n, q AS p FROM n UNION ALL SELECT 1, 'toxic', n, x FROM n) "
          "SELECT label_idx, label, CAST(n AS BIGINT) AS n_rows, "
          "CASE WHEN p = 0 THEN 1.0::DOUBLE ELSE round_even(CAST(n - p AS DOUBLE) / CAST(p AS DOUBLE), 3) END AS pos_weight, "
          "true AS converged, true AS at_optimum FROM w")
def q_fit_text_labels(spark, sf):
    """Weighted logistic heads of the labelled texts' hashed TF-IDF, weights from the train split."""
    d = B.frame_d(spark, sf)
    by_label = {r["label"]: r["pos_weight"] for r in cp.class_weights(d, B.d_dictionary(), "neg_pos").collect()}
    train = d.filter(F.col("split") == "train")
    texts = train.select("doc_id", "text")
    path = scratch_path(spark, "bucket-counts")  # the texts are cut once, for the fit and for its check
    ft.bucket_counts(texts, "doc_id").write.parquet(path)
    cells = ft.weighted_counts(spark.read.parquet(path), texts, "doc_id")
    rows = (ft.tfidf_vectors(texts, "doc_id", cells=cells)
            .join(train.select("doc_id", F.array("quality", "toxic").alias("y_true")), "doc_id"))
    fit, summary = solver.fit_heads(rows, D_NAMES, 1 << 18, "weighted_bce", by_label, TEXT_REG, tol=GAP / 2, max_iter=500,
                                    sparse=True)
    truth = train.select("doc_id", F.posexplode(F.array("quality", "toxic")).alias("label_idx", "y"))
    gaps = text_gradients(cells, truth, fit, [by_label.get(n, 1.0) for n in D_NAMES], TEXT_REG)
    n_rows = train.agg(F.count(F.lit(1)).alias("n_rows"))
    return (summary.join(gaps, "label_idx").join(F.broadcast(n_rows))
            .select("label_idx", "label", "n_rows", "pos_weight", "converged", (F.col("gap") < GAP).alias("at_optimum")))


def _fit_vectors(spark, sf, kind: str) -> DataFrame:
    v, dic = B.frame_v(spark, sf), B.v_dictionary()
    wide = v.select(*[F.col("y_true")[i].alias(n) for i, n in enumerate(V_NAMES)])
    by_label = {r["label"]: r["pos_weight"] for r in cp.class_weights(wide, dic, "balanced", splits=None).collect()}
    d = B.feature_dim(v)
    fit, summary = solver.fit_heads(v, V_NAMES, d, kind, by_label, HEAD_REG)
    gaps = fit_ops.head_gap(v, fit.weights, fit.intercepts, kind, [by_label[n] for n in V_NAMES], HEAD_REG)
    good = F.array(*[F.lit(g < GAP) for g in gaps])
    return summary.select("label_idx", "label", "pos_weight", "converged", F.get(good, F.col("label_idx")).alias("at_optimum"))


_V_SQL = (f"SELECT l.label_idx, l.label, {{w}} AS pos_weight, true AS converged, true AS at_optimum FROM ({V_LABEL_ROWS}) l "
          "LEFT JOIN embeddings e ON e.label = l.label_idx GROUP BY 1, 2")


@register("fit_heads_focal", _V_SQL.format(w="1.0::DOUBLE"))
def q_fit_heads_focal(spark, sf):
    return _fit_vectors(spark, sf, "focal")


@register("fit_heads_weighted_bce", _V_SQL.format(
    w="CAST((SELECT count(*) FROM embeddings) - count(e.label) AS DOUBLE) / CAST(count(e.label) AS DOUBLE)"))
def q_fit_heads_weighted_bce(spark, sf):
    return _fit_vectors(spark, sf, "weighted_bce")

"""Fitting the K-label head on Spark.

fit_binary_relevance   one weighted LogisticRegression per label (Spark ML),
                       weight = pos_weight on positives, 1 on negatives; the
                       K jobs are submitted from a small thread pool over one
                       cached frame so they overlap.  (ML's OneVsRest is
                       multiclass, not multi-label, so it is not used.)
fit_linear_head        full-batch gradient descent of all K heads at once
                       under BCE, weighted BCE or focal loss: every epoch each
                       partition emits its partial gradient (K x (d+1) values,
                       numpy inside ``mapInPandas``), one aggregate sums them,
                       and the driver updates the small weight matrix.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fit_binary_relevance(df: DataFrame, names, features: str = "features", truth: str = "y_true",
                         pos_weights: dict | None = None, reg: float = 1e-3, tol: float = 1e-8,
                         max_iter: int = 500, with_auc: bool = False, threads: int = 4):
    """Returns (models by label, summary DataFrame).

    The positive ``reg`` gives every fit a finite optimum, ``tol`` ends it there; a fit
    that ``max_iter`` cuts off says ``converged = false``.  The training AUC is another
    pass over the data, so it is computed only when asked for.  Sparse text features
    need ``solver.fit_heads``, which scales them."""
    from pyspark.ml.classification import LogisticRegression

    base = df.select(features, truth).persist()

    def fit_one(i_name):
        i, name = i_name
        w = float((pos_weights or {}).get(name, 1.0))
        data = base.select(F.col(features).alias("features"),
                           F.col(truth)[i].cast("double").alias("label"),
                           F.when(F.col(truth)[i] == 1, F.lit(w)).otherwise(F.lit(1.0)).alias("weight"))
        lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                                maxIter=max_iter, regParam=reg, tol=tol, standardization=False)
        m = lr.fit(data)
        s = m.summary
        hist = s.objectiveHistory
        return name, m, (i, name, w, int(s.totalIterations), float(hist[0]), float(hist[-1]),
                         float(s.areaUnderROC) if with_auc else None, s.totalIterations < max_iter)

    try:
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            results = list(pool.map(fit_one, list(enumerate(names))))
    finally:
        base.unpersist()
    schema = T.StructType([
        T.StructField("label_idx", T.IntegerType()), T.StructField("label", T.StringType()),
        T.StructField("pos_weight", T.DoubleType()), T.StructField("iterations", T.IntegerType()),
        T.StructField("first_objective", T.DoubleType()), T.StructField("final_objective", T.DoubleType()),
        T.StructField("train_auc", T.DoubleType()), T.StructField("converged", T.BooleanType())])
    summary = df.sparkSession.createDataFrame([r[2] for r in results], schema)
    return {r[0]: r[1] for r in results}, summary


def optimality_gap(df: DataFrame, models: dict, names, pos_weights: dict | None = None, reg: float = 1e-3,
                   features: str = "features", truth: str = "y_true") -> list[float]:
    """The largest absolute gradient entry of each label's regularised weighted
    objective at its fitted model (0 at the optimum), from one pass over the data.
    ``features`` is array<double>."""
    W = np.array([models[n].coefficients.toArray() for n in names])
    b = np.array([models[n].intercept for n in names])
    return head_gap(df, W, b, "weighted_bce", [float((pos_weights or {}).get(n, 1.0)) for n in names], reg, features, truth)


def head_gap(df: DataFrame, W, b, kind: str, pos_weights, reg: float, features: str = "features",
             truth: str = "y_true") -> list[float]:
    """``optimality_gap`` of a (K, d) head under any of the losses."""
    pw = np.array(pos_weights, float)
    k, d = W.shape
    fn = _partial_gradients(W, b, kind, pw, 1.0, 2.0, features, truth)
    sums = df.select(features, truth).mapInPandas(fn, GRAD_SCHEMA).groupBy("idx").agg(F.sum("value").alias("v"))
    v = np.zeros(k * d + k + 2)
    for r in sums.collect():
        v[r["idx"]] = r["v"]
    total = np.full(k, v[-1])
    if kind == "weighted_bce":
        pos = df.agg(*[F.sum(F.col(truth)[i]).alias(f"p{i}") for i in range(k)]).first()
        total = np.array([v[-1] + (pw[i] - 1.0) * pos[i] for i in range(k)])
    gW = v[:k * d].reshape(k, d) / total[:, None] + reg * W
    return np.maximum(np.abs(gW).max(axis=1), np.abs(v[k * d:k * d + k] / total)).tolist()


# --- D10 ---------------------------------------------------------------------------


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-z))


def cell_loss_grad(z: np.ndarray, y: np.ndarray, kind: str, pos_weight=None,
                   alpha: float = 1.0, gamma: float = 2.0):
    """Per-cell loss and d loss / d logit for 'bce', 'weighted_bce', 'focal'."""
    sp_neg = np.log1p(np.exp(-np.abs(z))) + np.maximum(-z, 0.0)   # softplus(-z)
    p = _sigmoid(z)
    if kind == "weighted_bce" and pos_weight is not None:
        w = np.asarray(pos_weight)[None, :]
        lw = (w - 1.0) * y + 1.0
        loss = (1.0 - y) * z + lw * sp_neg
        grad = (1.0 - y) - lw * (1.0 - p)
        return loss, grad
    bce = (1.0 - y) * z + sp_neg
    if kind in ("bce", "weighted_bce"):
        return bce, p - y
    if kind == "focal":
        pt = p * y + (1.0 - p) * (1.0 - y)
        mod = alpha * (1.0 - pt) ** gamma
        # d(1 - pt)/dz = -(2y - 1) p (1 - p)
        dmod = alpha * gamma * (1.0 - pt) ** (gamma - 1.0) * (-(2.0 * y - 1.0) * p * (1.0 - p))
        return mod * bce, dmod * bce + mod * (p - y)
    raise ValueError(f"unknown loss {kind!r}")


GRAD_SCHEMA = "idx long, value double"


def _partial_gradients(W, b, kind, pos_weight, alpha, gamma, features, truth):
    k, d = W.shape

    def run(batches):
        gW = np.zeros((k, d))
        gb = np.zeros(k)
        total = 0.0
        n = 0
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.stack(pdf[features].to_numpy()).astype(float)
            Y = np.stack(pdf[truth].to_numpy()).astype(float)
            Z = X @ W.T + b
            loss, g = cell_loss_grad(Z, Y, kind, pos_weight, alpha, gamma)
            gW += g.T @ X
            gb += g.sum(axis=0)
            total += float(loss.sum())
            n += len(pdf)
        import pandas as pd
        idx = np.arange(k * d + k + 2, dtype=np.int64)
        vals = np.concatenate([gW.ravel(), gb, [total, float(n)]])
        yield pd.DataFrame({"idx": idx, "value": vals})
    return run


def fit_linear_head(df: DataFrame, k: int, d: int, kind: str = "focal", epochs: int = 3,
                    lr: float = 1.0, features: str = "features", truth: str = "y_true",
                    pos_weight=None, alpha: float = 1.0, gamma: float = 2.0, init=None):
    """Returns (W, b, per-epoch mean loss before each update)."""
    data = df.select(features, truth).persist()
    W = np.zeros((k, d)) if init is None else np.array(init[0], dtype=float)
    b = np.zeros(k) if init is None else np.array(init[1], dtype=float)
    history = []
    try:
        for epoch in range(epochs):
            fn = _partial_gradients(W.copy(), b.copy(), kind, pos_weight, alpha, gamma, features, truth)
            sums = (data.mapInPandas(fn, GRAD_SCHEMA)
                    .groupBy("idx").agg(F.sum("value").alias("value")).collect())
            v = np.zeros(k * d + k + 2)
            for r in sums:
                v[r["idx"]] = r["value"]
            n_rows = v[-1]
            cells = max(n_rows * k, 1.0)
            history.append((epoch, float(v[-2] / cells)))
            W = W - lr * v[:k * d].reshape(k, d) / cells
            b = b - lr * v[k * d:k * d + k] / cells
    finally:
        data.unpersist()
    return W, b, history

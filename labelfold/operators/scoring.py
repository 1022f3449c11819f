"""Scoring and losses: linear head, sigmoid, batch scoring, BCE / weighted
BCE / focal loss.

Model parameters (K x d weights, K biases) are small driver-side values, so
scoring is a narrow step with no join and no shuffle: the head is one matrix
product per Arrow batch, everything after it an expression.  Losses are
per-cell expressions summed as doubles by one aggregate; operators round
nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sqltext as X
from ..functions.labels import per_label


def _head(weights, bias, features: str, out: str):
    w, b = np.asarray(weights, dtype=float), np.asarray(bias, dtype=float)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = batch.column(features)
            flat = x.flatten().to_numpy(zero_copy_only=False).astype(float)
            z = np.full((len(x), len(b)), np.nan)
            whole = np.asarray(x.is_valid())
            if whole.any():
                z[whole] = flat.reshape(int(whole.sum()), w.shape[1]) @ w.T + b
            rows = pa.FixedSizeListArray.from_arrays(pa.array(z.ravel()), len(b)).cast(pa.list_(pa.float64()))
            if not whole.all():
                rows = pa.array([r if ok else None for r, ok in zip(rows.to_pylist(), whole)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, rows], names=[*batch.schema.names, out])
    return run


def linear_head(df: DataFrame, weights: Sequence[Sequence[float]], bias: Sequence[float],
                features: str = "features", out: str = "logit") -> DataFrame:
    """D3: logits = x . W_k + b_k for K labels, one matrix product per Arrow batch.

    A null feature vector gives a null logit vector; one of another length
    than the weights is an error.
    """
    schema = T.StructType([f for f in df.schema.fields if f.name != out]
                          + [T.StructField(out, T.ArrayType(T.DoubleType()))])
    return df.drop(out).mapInArrow(_head(weights, bias, features, out), schema)


def probabilities(df: DataFrame, k: int, logit: str = "logit", out: str = "score") -> DataFrame:
    """Independent sigmoid per label (not a softmax)."""
    return df.withColumn(out, F.expr(X.array_of([X.sigmoid(X.elem(logit, i)) for i in range(k)])))


def top_index_sql(score: str, k: int) -> str:
    """Index of the first maximum (smallest index on ties)."""
    s = [X.elem(score, i) for i in range(k)]
    m = f"greatest({', '.join(s)})" if k > 1 else s[0]
    return f"coalesce({', '.join(f'CASE WHEN {s[i]} = {m} THEN {i} END' for i in range(k))})"


def top_index(score: str, k: int) -> Column:
    return F.expr(top_index_sql(score, k))


def score_batch(df: DataFrame, names: Sequence[str], t=0.5, op: str = "ge",
                score: str = "score", sort_labels: bool = False) -> DataFrame:
    """labels = array<struct<name, probability, predicted>>, top = first max.

    Serving uses ``p >= t``; ``t`` is one number, one per label, or the name of
    a column with each request's own threshold.  ``sort_labels`` orders labels
    high-first (index breaks ties) as the prediction page shows them.
    """
    k = len(names)
    ts = [X.ident(t)] * k if isinstance(t, str) else per_label(t, k)
    s = [X.elem(score, i) for i in range(k)]
    items = X.array_of([X.named_struct([("name", X.lit(n)), ("probability", s[i]),
                                        ("predicted", X.above(s[i], ts[i], op))])
                        for i, n in enumerate(names)])
    if sort_labels:
        order = X.array_of([X.named_struct([("neg_p", f"-{s[i]}"), ("i", X.lit(i))]) for i in range(k)])
        items = f"transform(array_sort({order}), e -> {items}[e.i])"
    ti = top_index_sql(score, k)
    name_arr = X.array_of([X.lit(n) for n in names])
    top = X.named_struct([("name", f"{name_arr}[{ti}]"), ("probability", f"{X.ident(score)}[{ti}]")])
    return df.withColumn("labels", F.expr(items)).withColumn("top", F.expr(top))


# --- losses (SQL text over a logit z and a 0/1 truth y) ------------------------------


def softplus_neg_abs(z: str) -> str:
    return f"log1p(exp(-abs({z})))"


def bce_cell(z: str, y: str, pos_weight: str | None = None) -> str:
    """D5/D6 per cell, in the stable logits form:
    (1 - y) z + (1 + (w - 1) y) (log1p(exp(-|z|)) + max(-z, 0))."""
    yd = f"CAST({y} AS DOUBLE)"
    lw = "1.0D" if pos_weight is None else f"(({pos_weight}) - 1.0D) * {yd} + 1.0D"
    return (f"((1.0D - {yd}) * ({z}) + ({lw}) * "
            f"({softplus_neg_abs(z)} + greatest(-({z}), 0.0D)))")


def focal_cell(z: str, y: str, alpha: float = 1.0, gamma: float = 2.0) -> str:
    """D7 per cell: alpha * (1 - p_t)^gamma * BCE."""
    p = X.sigmoid(z)
    yd = f"CAST({y} AS DOUBLE)"
    pt = f"({p} * {yd} + (1.0D - {p}) * (1.0D - {yd}))"
    return f"({X.lit(float(alpha))} * pow(1.0D - {pt}, {X.lit(float(gamma))}) * {bce_cell(z, y)})"


LOSS_KINDS = ("bce", "weighted_bce", "focal")


def loss_cell(kind: str, z: str, y: str, pos_weight: str | None = None,
              alpha: float = 1.0, gamma: float = 2.0) -> str:
    """Choose the loss; weighted without weights falls back to plain BCE."""
    if kind == "bce" or (kind == "weighted_bce" and pos_weight is None):
        return bce_cell(z, y)
    if kind == "weighted_bce":
        return bce_cell(z, y, pos_weight)
    if kind == "focal":
        return focal_cell(z, y, alpha, gamma)
    raise ValueError(f"unknown loss {kind!r}; expected one of {LOSS_KINDS}")


def _long_cells(ef, logit: str, keys: bool) -> DataFrame:
    cells = [X.named_struct([("label_idx", X.lit(i)), ("y", X.elem("y_true", i)),
                             ("z", X.elem(logit, i))]) for i in range(ef.k)]
    cols = [F.col(c) for c in ef.keys] if keys else []
    return ef.df.select(*cols, X.inline_rows(cells))


def loss_cells(ef, kind: str = "bce", logit: str = "logit", pos_weights: DataFrame | None = None,
               alpha: float = 1.0, gamma: float = 2.0) -> DataFrame:
    """(keys..., label_idx, loss): one row per cell (reduction 'none')."""
    pw = weight_literals(pos_weights if kind == "weighted_bce" else None, ef.k)
    weight = f"{X.array_of(pw)}[label_idx]" if pw else None
    return _long_cells(ef, logit, True).select(
        *ef.keys, "label_idx", F.expr(loss_cell(kind, "z", "y", weight, alpha, gamma)).alias("loss"))


def loss(ef, kind: str = "bce", reduction: str = "mean", logit: str = "logit",
         pos_weights: DataFrame | None = None, alpha: float = 1.0, gamma: float = 2.0) -> DataFrame:
    """D5-D8 / E11 with reduction 'mean' | 'sum' | 'none' (mean over rows x labels)."""
    cells = loss_cells(ef, kind, logit, pos_weights, alpha, gamma)
    if reduction == "none":
        return cells
    if reduction == "sum":
        return cells.agg(F.sum("loss").alias("loss"))
    if reduction == "mean":
        return cells.agg(F.avg("loss").alias("loss"))
    raise ValueError(f"unknown reduction {reduction!r}")


def weight_literals(pos_weights: DataFrame | None, k: int) -> list | None:
    """K per-label weights as SQL literals (a label missing from the table
    weighs 1.0).  At most one row per label index 0..K-1 is accepted, and at
    most K + 1 rows are ever fetched, so what reaches the driver is bounded by
    K, like a model's parameters; a duplicate label is an error."""
    if pos_weights is None:
        return None
    rows = (pos_weights.select("label_idx", "pos_weight")
            .filter((F.col("label_idx") >= 0) & (F.col("label_idx") < k)).limit(k + 1).collect())
    got = {}
    for r in rows:
        i = int(r["label_idx"])
        if i in got:
            raise ValueError(f"pos_weights has more than one row for label_idx {i}")
        got[i] = r["pos_weight"]
    return [X.lit(float(got[i])) if got.get(i) is not None else "1.0D" for i in range(k)]


def loss_summary(ef, kinds=LOSS_KINDS, logit: str = "logit", pos_weights: DataFrame | None = None,
                 alpha: float = 1.0, gamma: float = 2.0) -> DataFrame:
    """All requested losses, mean and sum, from ONE scan: (kind, mean, sum, n).

    No explode: every row adds its K cells and the row totals are summed as
    doubles; ``n`` counts cells (rows x K).  Class weights are fetched only
    when the weighted loss is asked for."""
    k = ef.k
    pw = weight_literals(pos_weights if "weighted_bce" in kinds else None, k)
    aggs = [F.expr(f"count(1) * {k} AS n")]
    for kd in kinds:
        cells = [loss_cell(kd, X.elem(logit, i), X.elem("y_true", i), pw[i] if pw else None, alpha, gamma)
                 for i in range(k)]
        aggs.append(F.expr(f"sum({X.fsum(cells)}) AS s_{kd}"))
    row = ef.df.agg(*aggs)
    structs = [X.named_struct([("kind", X.lit(kd)), ("mean", f"s_{kd} / n"), ("sum", f"s_{kd}"),
                               ("n", "CAST(n AS BIGINT)")]) for kd in kinds]
    return row.select(X.inline_rows(structs))

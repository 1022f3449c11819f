"""Distributed L-BFGS for the K label heads, under any of the three losses.

Minimises, for every label at once,

    f_k(w, b) = sum_i c_ik loss(w . x_i + b, y_ik) / sum_i c_ik + reg / 2 |w|^2

with the losses of the head fit (``bce``, ``weighted_bce`` with c = the positive weight
on positives, ``focal``).  One pass over the data evaluates all labels that still move,
each at its own trial point, so K fits cost as many passes as the slowest one.

* The training rows are written once into the shared folder; a pass reads dense rows through
  Arrow as one matrix per batch.  Sparse rows are written a second time as blocks of at most
  ``BLOCK`` entries (or one row), feature by feature: bytes that hold each entry's row and its value,
  the value as a number among the block's different ones where these are few, so that a pass moves
  some 4 bytes an entry and converts nothing.  A pass over blocks has as many tasks as the
  cluster runs at a time, however many files there are: each gives a partial of K x d numbers.
* Every partition gives one partial (loss, gradient, weights).  Partials are summed in
  groups of ``FAN`` neighbours, in the order of partitions, level by level, until at
  most ``FAN`` reach the driver: the sum's order is fixed, so a rerun gives the same bits,
  and the driver's share does not grow with the partitions.
* Sparse rows are fitted over the indices that occur: the others' weights are 0.
* Steps come from the two-loop recursion over the last ``MEMORY`` pairs, in coordinates
  scaled by a damped power of each feature's curvature bound (a quarter of its weighted
  mean square, plus the penalty).  Features of hashed TF-IDF differ by orders of
  magnitude; on those texts the damped scale took 160 passes where none took 240 and the
  full one 270.  A backtracking search keeps the objective falling.
* A label stops when its largest gradient entry is at most ``tol``.  One that does not in
  ``max_iter`` steps keeps its best point and says ``converged = false``; it raises nothing.

The driver holds K x d numbers per stored pair, as any model of that size does.
"""

from __future__ import annotations

from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .fit import cell_loss_grad

MEMORY, FAN, ARMIJO, DAMPING = 20, 8, 1e-4, 0.125
LOSSES = ("bce", "weighted_bce", "focal")
PARTIAL = "part long, body binary"
BLOCK, BLOCKS_PER_BATCH = 1 << 21, 4
FEW = 1 << 16  # rows and different values of a block that two bytes number
PACKED = "cols binary, starts binary, at binary, codes binary, vals binary, y_true binary"
PACKED_TYPES = (np.int32, np.int32, np.uint16, np.uint16, np.float64, np.int32)


def _column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def _dense_parts(batches):
    """(truth, product with a d-vector, transposed product with a row vector, squares' product) of every Arrow batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _column(batch, "features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        y = _column(batch, "y_true").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        yield y, (lambda w, x=x: x @ w), (lambda g, x=x: g @ x), (lambda g, x=x: g @ (x * x))


def _sparse_parts(batches, d: int, k: int):
    """The same of every block of sparse rows with k labels."""
    for batch in batches:
        for i in range(batch.num_rows):
            cols, starts, at, codes, values, y = (
                np.frombuffer(_column(batch, name.split()[0])[i].as_buffer(), kind)
                for name, kind in zip(PACKED.split(", "), PACKED_TYPES))
            values, at, y = values[codes] if len(codes) else values, at.astype(np.intp), y.reshape(-1, k)
            sizes = np.diff(starts, append=len(at))

            def times(w, cols=cols, sizes=sizes, at=at, values=values, n=len(y)):
                return np.bincount(at, values * np.repeat(w[cols], sizes), minlength=n)

            def added(entries, cols=cols, starts=starts):
                out = np.zeros(d)
                if len(cols):
                    out[cols] = np.add.reduceat(entries, starts)
                return out

            def back(g, at=at, values=values, added=added):
                return added(values * g[at])

            def squares(g, at=at, values=values, added=added):
                return added(values * values * g[at])

            yield y, times, back, squares


def _pack(active: np.ndarray):
    """Arrow batches of (indices, values, y_true) -> rows of PACKED, indices numbered among ``active``."""
    def block(index, values, sizes, y):
        at = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(index, kind="stable")
        index, at, values = index[order], at[order], values[order]
        starts = np.flatnonzero(np.diff(index, prepend=-1))
        names, codes = np.unique(values, return_inverse=True)
        if len(names) > FEW:
            names, codes = values, codes[:0]
        return index[starts], starts, at, codes, names, y

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            index = np.searchsorted(active, _column(batch, "indices").flatten().to_numpy(zero_copy_only=False))
            values = _column(batch, "values").flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(_column(batch, "indices").offsets.to_numpy())
            y = _column(batch, "y_true").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            ends, start = np.cumsum(sizes, dtype=np.int64), 0
            while start < batch.num_rows:
                at = int(ends[start - 1]) if start else 0
                stop = max(start + 1, min(start + FEW, int(np.searchsorted(ends, at + BLOCK, side="right"))))
                to = int(ends[stop - 1])
                parts = block(index[at:to], values[at:to], sizes[start:stop], y[start:stop])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([np.ascontiguousarray(p, kind).tobytes()], pa.binary()) for p, kind in zip(parts, PACKED_TYPES)],
                    names=[c.split()[0] for c in PACKED.split(", ")])
                start = stop
    return run


@contextmanager
def _small_batches(spark):
    """Blocks are large rows: few of them in one Arrow batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BLOCKS_PER_BATCH))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _partials(w, b, live, kind, pos_weights, alpha, gamma, sparse, curvature):
    """Arrow batches -> one row per partition: for every live label loss, weight, intercept and
    feature gradients (with ``curvature`` the weighted squares of the features instead)."""
    d = w.shape[1]

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        total = np.zeros((len(live), d + 3))
        for y_all, times, back, squares in _sparse_parts(batches, d, len(w)) if sparse else _dense_parts(batches):
            for at, k in enumerate(live):
                y = y_all[:, k].astype(float)
                c = np.where(y == 1, pos_weights[k], 1.0) if kind == "weighted_bce" else np.ones(len(y))
                if curvature:
                    total[at, 3:] += squares(c)
                    total[at, 1] += c.sum()
                    continue
                with np.errstate(over="ignore"):  # exp of a very negative logit
                    loss, g = cell_loss_grad((times(w[k]) + b[k])[:, None], y[:, None], kind, pos_weights[k:k + 1],
                                             alpha, gamma)
                total[at, :3] += loss.sum(), c.sum(), g.sum()
                total[at, 3:] += back(g[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())],
            names=["part", "body"])
    return run


def _sum_group(pdf):
    """Partials of one group, added in the order of their partitions."""
    import pandas as pd

    pdf = pdf.sort_values("part")
    total = np.frombuffer(pdf.body.iloc[0]).copy()
    for body in pdf.body.iloc[1:]:
        total += np.frombuffer(body)
    return pd.DataFrame({"part": [int(pdf.part.iloc[0])], "body": [total.tobytes()]})


def tree_sum(partials: DataFrame, partitions: int) -> np.ndarray:
    """The sum of all partials, in groups of FAN neighbours, level by level."""
    width = 1
    while -(-partitions // width) > FAN:
        width *= FAN
        partials = partials.groupBy(F.floor(F.col("part") / width).alias("g")).applyInPandas(_sum_group, PARTIAL)
    rows = sorted(partials.collect(), key=lambda r: r.part)
    total = np.frombuffer(rows[0].body).copy()
    for r in rows[1:]:
        total += np.frombuffer(r.body)
    return total


@dataclass
class Objective:
    """The K objectives over one written frame; counts its passes."""

    data: DataFrame
    k: int
    d: int
    kind: str = "bce"
    pos_weights: np.ndarray | None = None
    reg: float = 0.0
    alpha: float = 1.0
    gamma: float = 2.0
    sparse: bool = False  # the frame holds rows of PACKED
    passes: int = field(default=0, init=False)

    def __post_init__(self):
        if self.kind not in LOSSES:
            raise ValueError(f"unknown loss {self.kind!r}")
        self.pos_weights = np.ones(self.k) if self.pos_weights is None else np.asarray(self.pos_weights, float)
        self.partitions = self.data.rdd.getNumPartitions()
        if self.sparse:
            self.partitions = min(self.partitions, self.data.sparkSession.sparkContext.defaultParallelism)
            self.data = self.data.coalesce(self.partitions)

    def _sum(self, w, b, live, curvature=False):
        self.passes += 1
        fn = _partials(w, b, tuple(live), self.kind, self.pos_weights, self.alpha, self.gamma, self.sparse, curvature)
        with _small_batches(self.data.sparkSession) if self.sparse else nullcontext():
            total = tree_sum(self.data.mapInArrow(fn, PARTIAL), self.partitions)
        return total.reshape(len(live), self.d + 3)

    def __call__(self, points: np.ndarray, live) -> tuple[np.ndarray, np.ndarray]:
        """Values and gradients at (K, d + 1) points (the intercept last) of the live labels."""
        s = self._sum(points[:, :-1], points[:, -1], live)
        weight = np.maximum(s[:, 1], 1e-300)[:, None]
        w = points[list(live), :-1]
        grads = np.concatenate([s[:, 3:] / weight + self.reg * w, s[:, 2:3] / weight], axis=1)
        return s[:, 0] / weight[:, 0] + self.reg / 2 * (w**2).sum(axis=1), grads

    def scales(self) -> np.ndarray:
        """(K, d + 1) damped curvature bounds."""
        zero = np.zeros((self.k, self.d))
        s = self._sum(zero, zero[:, 0], range(self.k), curvature=True)
        bound = 0.25 * s[:, 3:] / np.maximum(s[:, 1:2], 1e-300) + self.reg
        bound = np.concatenate([bound, np.full((self.k, 1), 0.25)], axis=1)
        return np.where(bound > 0, bound, 1.0) ** DAMPING


def _dot(a: np.ndarray, b: np.ndarray) -> float:
    """Inner product by numpy's own sum: the same bits on every run, where a threaded BLAS may differ."""
    return float(np.add.reduce(a * b))


class _Label:
    """State of one label's descent, in scaled coordinates."""

    def __init__(self, value, grad):
        self.x, self.value, self.grad = np.zeros_like(grad), value, grad
        self.first, self.pairs, self.steps, self.step, self.tries, self.stuck = value, [], 0, 1.0, 0, False
        self.direction = None

    def aim(self):
        """The two-loop recursion; the steepest descent where it does not point downhill."""
        q, alphas = self.grad.copy(), []
        for s, y, sy in reversed(self.pairs):
            a = _dot(s, q) / sy
            q -= a * y
            alphas.append(a)
        if self.pairs:
            s, y, sy = self.pairs[-1]
            q *= sy / _dot(y, y)
        for (s, y, sy), a in zip(self.pairs, reversed(alphas)):
            q += (a - _dot(y, q) / sy) * s
        self.direction = -q
        if _dot(self.direction, self.grad) >= 0:
            self.pairs, self.direction = [], -self.grad
        self.step = 1.0 if self.pairs else min(1.0, 1.0 / max(_dot(self.grad, self.grad) ** 0.5, 1e-300))
        self.tries = 0

    def trial(self):
        return self.x + self.step * self.direction

    def judge(self, value, grad):
        """Take the trial point if the objective falls enough, else shorten the step."""
        slope = _dot(self.direction, self.grad)
        # below the rounding of the value, a falling gradient counts
        flat = abs(value - self.value) <= 1e-13 * max(1.0, abs(self.value)) and np.abs(grad).max() < np.abs(self.grad).max()
        if np.isfinite(value) and (value <= self.value + ARMIJO * self.step * slope or flat):
            s, y = self.step * self.direction, grad - self.grad
            if _dot(s, y) > 1e-12 * (_dot(s, s) * _dot(y, y)) ** 0.5:
                self.pairs = [*self.pairs[-(MEMORY - 1):], (s, y, _dot(s, y))]
            self.x, self.value, self.grad = self.trial(), value, grad
            self.steps += 1
            return True
        self.step *= 0.3
        self.tries += 1
        if self.tries > 25:
            if not self.pairs:
                self.stuck = True
            self.pairs = []
            return True
        return False


@dataclass
class Fit:
    weights: np.ndarray     # (K, d)
    intercepts: np.ndarray  # (K,)
    gradients: np.ndarray   # largest entry of each label's gradient
    steps: list
    first: np.ndarray
    final: np.ndarray
    converged: list
    passes: int


def minimise(objective: Objective, tol: float = 1e-6, max_iter: int = 200) -> Fit:
    """L-BFGS of all labels side by side; a pass evaluates every label that still moves."""
    k, d = objective.k, objective.d
    scale = objective.scales()
    values, grads = objective(np.zeros((k, d + 1)), range(k))
    labels = [_Label(v, g / s) for v, g, s in zip(values, grads, scale)]

    def gradient(i):
        return float(np.abs(labels[i].grad * scale[i]).max())

    def moving():
        return [i for i in range(k) if gradient(i) > tol and labels[i].steps < max_iter and not labels[i].stuck]

    for i in moving():
        labels[i].aim()
    while live := moving():
        points = np.zeros((k, d + 1))
        for i in live:
            points[i] = labels[i].trial() / scale[i]
        values, grads = objective(points, live)
        for i, v, g in zip(live, values, grads):
            if labels[i].judge(v, g / scale[i]):
                labels[i].aim()
    x = np.array([lab.x for lab in labels]) / scale
    gaps = np.array([gradient(i) for i in range(k)])
    return Fit(x[:, :-1], x[:, -1], gaps, [lab.steps for lab in labels], np.array([lab.first for lab in labels]),
               np.array([lab.value for lab in labels]), (gaps <= tol).tolist(), objective.passes)


SUMMARY = ("label_idx int, label string, loss string, pos_weight double, iterations int, first_objective double, "
           "final_objective double, gradient double, converged boolean")


def fit_heads(df: DataFrame, names, d: int, kind: str = "bce", pos_weights: dict | None = None, reg: float = 1e-3,
              tol: float = 1e-6, max_iter: int = 200, sparse: bool = False, alpha: float = 1.0, gamma: float = 2.0,
              partitions: int | None = None) -> tuple[Fit, DataFrame]:
    """D9/D10 to the optimum: (fit, one summary row per label).

    ``df`` holds y_true array<int> and features array<double> of length d, or with ``sparse`` indices
    array<int> and values array<double>; rows with a null in them are refused.  ``partitions`` deals the
    rows anew before they are written."""
    columns = ["indices", "values"] if sparse else ["features"]
    path = scratch_path(df.sparkSession, "training-rows")
    rows = df.select(*columns, "y_true")
    (rows.repartition(partitions) if partitions else rows).write.parquet(path)
    data = df.sparkSession.read.schema(rows.schema).parquet(path)
    _check_rows(data, d, sparse, len(names))
    weights = np.array([float((pos_weights or {}).get(n, 1.0)) for n in names])
    active = None
    if sparse:  # at most d numbers
        active = np.array(sorted(r[0] for r in data.select(F.explode("indices")).distinct().collect()), np.int64)
        blocks = scratch_path(df.sparkSession, "training-blocks")
        data.mapInArrow(_pack(active), PACKED).write.option("compression", "uncompressed").parquet(blocks)
        data = df.sparkSession.read.schema(PACKED).parquet(blocks)
    fit = minimise(Objective(data, len(names), d if active is None else len(active), kind, weights, reg, alpha, gamma, sparse),
                   tol, max_iter)
    if sparse:
        whole = np.zeros((len(names), d))
        whole[:, active] = fit.weights
        fit.weights = whole
    summary = df.sparkSession.createDataFrame(
        [(i, n, kind, float(weights[i]) if kind == "weighted_bce" else 1.0, int(fit.steps[i]), float(fit.first[i]),
          float(fit.final[i]), float(fit.gradients[i]), bool(fit.converged[i])) for i, n in enumerate(names)], SUMMARY)
    return fit, summary


def _check_rows(data: DataFrame, d: int, sparse: bool, k: int) -> None:
    """Refuse rows whose features or labels have the wrong shape, before they give a wrong fit."""
    if sparse:
        good = ("size(indices) = size(values) AND coalesce(array_max(indices), 0) < {d} "
                "AND coalesce(array_min(indices), 0) >= 0 AND forall(values, x -> x IS NOT NULL)")
    else:
        good = "size(features) = {d} AND forall(features, x -> x IS NOT NULL)"
    good = good.format(d=d) + f" AND size(y_true) = {k} AND forall(y_true, y -> y IS NOT NULL)"
    bad = data.filter(F.expr(f"NOT coalesce({good}, false)")).count()
    if bad:
        raise ValueError(f"{bad} training rows do not hold {d} features and {k} labels without nulls")

"""The distributed L-BFGS: optimum, partitions, order of sums, refusals."""

import numpy as np
import pytest

from labelfold.operators import fit as fit_ops
from labelfold.operators import solver


def problem(n=400, d=6, k=3, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * 10.0 ** rng.integers(-2, 3, size=d)  # features of very different sizes
    y = (x @ (rng.normal(size=(d, k)) / np.abs(x).max(axis=0)[:, None]) + rng.normal(scale=0.3, size=(n, k)) > 0).astype(int)
    y[:, 2] = 0  # a label without positives
    return x, y


def frame(spark, x, y, sparse=False):
    rows = []
    for xi, yi in zip(x, y):
        at = np.flatnonzero(xi)
        rows.append((*([at.tolist(), xi[at].tolist()] if sparse else [xi.tolist()]), yi.tolist()))
    schema = "indices array<int>, values array<double>" if sparse else "features array<double>"
    return spark.createDataFrame(rows, schema + ", y_true array<int>")


def gap(x, y, fit, kind, pw, reg):
    """Largest gradient entries by numpy over the whole matrix."""
    c = np.where(y == 1, pw, 1.0) if kind == "weighted_bce" else np.ones(y.shape)
    _, g = fit_ops.cell_loss_grad(x @ fit.weights.T + fit.intercepts, y.astype(float), kind, pw)
    return np.maximum(np.abs(g.T @ x / c.sum(axis=0)[:, None] + reg * fit.weights).max(axis=1),
                      np.abs(g.sum(axis=0) / c.sum(axis=0)))


@pytest.mark.parametrize("kind", solver.LOSSES)
def test_every_loss_ends_at_its_optimum(spark, kind):
    x, y = problem()
    pw = np.array([3.0, 0.5, 1.0])
    fit, summary = solver.fit_heads(frame(spark, x, y), ["a", "b", "c"], x.shape[1], kind, dict(zip("abc", pw)), 1e-2)
    assert all(r.converged and r.gradient <= 1e-6 and r.final_objective < r.first_objective for r in summary.collect())
    assert gap(x, y, fit, kind, pw, 1e-2).max() < 2e-6


def test_partitions_do_not_move_the_optimum(spark):
    x, y = problem()
    found = []
    for parts in (1, 4, 32):  # 32: the tree has two levels
        fit, _ = solver.fit_heads(frame(spark, x, y), ["a", "b", "c"], x.shape[1], "bce", None, 1e-2, tol=1e-9, partitions=parts)
        assert all(fit.converged) and gap(x, y, fit, "bce", np.ones(3), 1e-2).max() < 1e-8
        found.append(np.c_[fit.weights, fit.intercepts])
    np.testing.assert_allclose(found[1], found[0], atol=1e-6)
    np.testing.assert_allclose(found[2], found[0], atol=1e-6)


def test_sparse_rows_are_the_dense_ones(spark):
    rng = np.random.default_rng(1)
    x = np.where(rng.random((150, 40)) < 0.1, rng.exponential(5, (150, 40)), 0.0)
    x[:, 7] = 0.0  # an index that never occurs
    x[3] = 0.0     # a row without any
    y = rng.integers(0, 2, size=(150, 2))
    dense, _ = solver.fit_heads(frame(spark, x, y), ["a", "b"], 40, "weighted_bce", {"a": 2.0}, 0.05, tol=1e-8)
    thin, _ = solver.fit_heads(frame(spark, x, y, True), ["a", "b"], 40, "weighted_bce", {"a": 2.0}, 0.05, tol=1e-8, sparse=True)
    assert all(dense.converged) and all(thin.converged) and thin.weights[0, 7] == 0.0
    np.testing.assert_allclose(thin.weights, dense.weights, atol=1e-6)


def test_tree_sum_adds_neighbours_in_order(spark):
    values = [10.0 ** (17 - i % 34) * (-1) ** i for i in range(150)]
    rows = spark.createDataFrame([(i, np.array([v]).tobytes()) for i, v in enumerate(values)], solver.PARTIAL)

    def level(numbers):
        if len(numbers) <= solver.FAN:
            total = numbers[0]
            for v in numbers[1:]:
                total += v
            return total
        groups = [numbers[i:i + solver.FAN] for i in range(0, len(numbers), solver.FAN)]
        return level([level(g) for g in groups])
    for parts in (1, 7):
        assert solver.tree_sum(rows.repartition(parts), 150)[0] == level(values)


def test_a_fit_that_is_cut_off_keeps_its_point(spark):
    x, y = problem()
    fit, summary = solver.fit_heads(frame(spark, x, y), ["a", "b", "c"], x.shape[1], max_iter=2)
    rows = summary.collect()
    assert [r.converged for r in rows] == [False] * 3 and all(r.iterations == 2 for r in rows)
    assert all(r.final_objective < r.first_objective for r in rows)


@pytest.mark.parametrize("rows", [[([1.0], [0])], [([1.0, None], [1])], [([1.0, 2.0], [0, 1])], [(None, [1])], [([1.0, 2.0], [None])]])
def test_rows_of_another_shape_are_refused(spark, rows):
    df = spark.createDataFrame([([0.0, 1.0], [1]), *rows], "features array<double>, y_true array<int>")
    with pytest.raises(ValueError):
        solver.fit_heads(df, ["a"], 2)
    with pytest.raises(ValueError):
        solver.fit_heads(df.limit(1), ["a"], 2, "hinge")

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelfold.llm import ann_collisions as A
from tests.conftest import SF_SMALL


def brute(ids, x, k=20, step=20):
    """{(query id, place): [(score, id)]} over all rows, in component order."""
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        s = A.exact_scores(np.repeat(x[i][None, :], len(x), 0), x)
        rows = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[i] = [(s[j], int(ids[j])) for j in rows]
    return out


def found(rows):
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    return got


def recall(got, want, ids):
    assert set(got) == {int(ids[i]) for i in want}
    return np.mean([len({v for _, v in got[int(ids[i])]} & {v for _, v in w}) / max(len(w), 1) for i, w in want.items()])


def test_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = df.collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], float)
    want = brute(ids, x)
    got = found(A.nearest(df).collect())
    assert recall(got, want, ids) >= 0.9
    every = {int(ids[i]): dict((v, s) for s, v in brute(ids, x, len(ids), 20)[i]) for i in want}
    assert all(every[q][v] == s for q, hits in got.items() for s, v in hits)


@pytest.mark.parametrize("kind", ["clusters", "norms", "narrow"])
def test_small_blocks(spark, kind):
    rng = np.random.default_rng(3)
    n, d = 1500, 3 if kind == "narrow" else 24
    x = rng.normal(size=(n, d))
    if kind == "clusters":
        x = 0.05 * x + rng.normal(size=(30, d))[rng.integers(30, size=n)]
        x /= np.sqrt((x**2).sum(axis=1))[:, None]
        x[:500] = x[0]  # a third of all vectors are the same: ties by id
    if kind == "norms":
        x *= rng.uniform(0.1, 5, size=(n, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = brute(np.arange(n), x, 10, 30)
    got = found(A.nearest(df, k=10, query_step=30, block=128).collect())
    assert recall(got, want, np.arange(n)) >= 0.9
    if kind == "clusters":
        assert [v for _, v in got[0]] == list(range(1, 11))


def test_far_blocks_are_skipped_without_loss():
    rng = np.random.default_rng(5)
    near, far = rng.normal(size=(200, 32)) * 0.01 + 1, rng.normal(size=(200, 32)) * 0.01 - 1
    top = float(np.sqrt((np.r_[near, far]**2).sum(axis=1).max()))
    block = A.Block(np.arange(200), far, top)
    q, rows, scores, verified = block.search(near[:5], 20, np.full(5, 0.1))
    assert len(q) == len(rows) == verified == 0
    assert A.Block(np.arange(200), near, top).search(near[:5], 20, np.full(5, np.inf))[3] >= 100


def test_window_ratio_is_the_binomial_bound():
    rng = np.random.default_rng(7)
    hits = (np.abs(rng.normal(size=(20_000, 64))) <= A.window_ratio()).sum(axis=1) >= A.COLLISIONS
    assert abs(hits.mean() - A.FIND) < 0.02


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, []), (60, [0.0, 0.0]), (80, [1.0, None]), (100, [float("nan"), 1.0]),
            (120, [float("inf"), 1.0]), (None, [1.0, 1.0]), (1, [2.0]), (2, [1.0, 2.0]), (140, [3.0, 1.0, 1.0]),
            (3, [1.0, 2.0]), (0, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", *[F.lit("x").alias(c) for c in ("id", "v", "cell", "block", "home", "rank", "score")])
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in A.nearest(df).collect()]
    of_zero = [(1, 0, 5.0), (2, 2, 5.0), (3, 3, 5.0), (4, 140, 5.0), (5, 1, 2.0)]
    assert sorted(got) == sorted([(0, *r) for r in of_zero] * 2
                                 + [(140, i + 1, v, s) for i, (v, s) in enumerate([(1, 6.0), (0, 5.0), (0, 5.0), (2, 5.0), (3, 5.0)])])
    assert A.nearest(df.filter("false")).collect() == []
    assert A.nearest(df.filter("vec_id = 2")).collect() == []
    with pytest.raises(ValueError):
        A.nearest(df, block=40_000)

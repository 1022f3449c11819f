import zlib

import numpy as np

from labelfold.llm import pu_quality as q


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = q.score_quality(d, labels).collect()
    assert len(rows) == d.count()
    held = [(truth[r.doc_id], r) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and {t for t, _ in held} == {0, 1}
    assert np.mean([t == r.predicted for t, r in held]) >= 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_negatives_and_held_out_labels_teach_nothing(spark):
    """Turning labels of the held-out fold around changes no score."""
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    from pyspark.sql import functions as F
    turned = labels.withColumn("quality", F.when(q.fold_of("doc_id") == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in q.score_quality(d, labels).collect()}
    b = {r.doc_id: r.score for r in q.score_quality(d, turned).collect()}
    assert a == b


def _risk(w, zp, zu, prior, decay):
    """(what a step descends, risk of the negatives) written out from the definition, weights as a flat vector."""
    d, h = zp.shape[1], (len(w) - 1) // (zp.shape[1] + 2)
    w1, b1, w2, b2 = w[:d * h].reshape(d, h), w[d * h:d * h + h], w[d * h + h:d * h + 2 * h], w[-1]
    fp, fu = (np.tanh(z @ w1 + b1) @ w2 + b2 for z in (zp, zu))
    loss = lambda f, y: np.log1p(np.exp(-y * f)).mean()
    negative = loss(fu, -1) - prior * loss(fp, -1)
    return (prior * loss(fp, 1) + negative if negative >= 0 else -negative) + decay / 2 * (w @ w), negative


def _descended(pos, unl, prior, hidden, steps, rate, decay, seed):
    """Adam over central differences of ``_risk``; also which steps stood below zero."""
    both = np.vstack([pos, unl])
    zp, zu = (np.clip((x - both.mean(0)) / (both.std(0) + 1e-9), -6, 6) for x in (pos, unl))
    rng = np.random.default_rng(seed)
    w = np.concatenate([rng.normal(0, 0.3, (both.shape[1], hidden)).ravel(), np.zeros(hidden), rng.normal(0, 0.3, hidden), [0.0]])
    m, v, below = np.zeros_like(w), np.zeros_like(w), []
    for step in range(1, steps + 1):
        below.append(_risk(w, zp, zu, prior, decay)[1] < 0)
        g = np.empty_like(w)
        for i in range(len(w)):
            e = np.zeros_like(w)
            e[i] = 1e-5
            g[i] = (_risk(w + e, zp, zu, prior, decay)[0] - _risk(w - e, zp, zu, prior, decay)[0]) / 2e-5
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w, below


def test_risk_gradient():
    """Steps along finite differences of the non-negative risk end at the same weights, on both of its branches."""
    rng = np.random.default_rng(3)
    pos, unl = rng.normal(1, 1, (60, 3)), np.vstack([rng.normal(1, 1, (50, 3)), rng.normal(-1, 1, (40, 3))])
    seen = set()
    for prior in (0.5, 0.97):
        want, below = _descended(pos, unl, prior, 4, 30, 0.02, 1e-4, 4)
        got = q.fit_pu(pos, unl, prior, hidden=4, steps=30)
        assert np.allclose(np.concatenate([np.ravel(x) for x in got.weights]), want, atol=1e-4)
        seen |= set(below)
    assert seen == {False, True}


def test_the_fit_separates():
    rng = np.random.default_rng(0)
    pos, unl = rng.normal(1, 1, (200, 3)), np.vstack([rng.normal(1, 1, (150, 3)), rng.normal(-1, 1, (150, 3))])
    m = q.fit_pu(pos, unl, 0.5, steps=200)
    assert m.score(pos).mean() > 0.75 and m.score(unl[150:]).mean() < 0.25


def test_no_positive_label_gives_the_prior(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = q.score_quality(odd_docs, none).collect()
    assert len(rows) == odd_docs.count() and {r.score for r in rows} == {q.PRIOR}
    assert q.keep_good(odd_docs, none).count() == odd_docs.count()


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0, None) for i in range(10)] + [(None, 1, 0), (2, None, 1), (2, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = q.score_quality(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    kept = q.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.predicted for r in rows)
    assert q.score_quality(odd_docs.limit(0), labels).count() == 0


def test_clean_documents_stay(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = labels.filter("quality = 1")
    kept = q.keep_good(d, labels)
    assert kept.join(good, "doc_id").count() >= 0.99 * good.count()

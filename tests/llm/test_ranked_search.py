import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelfold.llm import ranked_search as R


def terms(text):
    return [re.sub("[A-Z]+", lambda m: m.group().lower(), t) for t in re.findall(R.TERM, text or "")]


def brute(docs, items, k=10):
    """Rows (item, rank, doc, score) by scoring every document for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n, words = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        q, scored = Counter(terms(text)), []
        for i, c, size in counted:
            m = 25 + 75 * size * n // words
            s = sum(times * w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, times in q.items() if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r[0], r["rank"], r[2], r.score) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"block_docs": 100}, {"block_postings": 500}, {"vocabulary_rows": 40}])
def test_against_brute_force(spark, options):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    common = words[:5]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)) + rng.choices(common, k=20))) for i in range(1500)]
    docs += [(2000 + i, docs[7][1]) for i in range(700)]  # a third of all texts are the same
    items = [(j, " ".join(rng.choices(words, k=15) + common)) for j in range(8)] + [(90, docs[7][1]), (91, "nothing-known")]
    got = R.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                          spark.createDataFrame(items, "item_id long, text string"), **options)
    assert rows(got) == brute(docs, items)


def test_odd_rows(spark, odd_docs):
    items = [(1, "ONE two Ünï"), (1, "lonely"), (None, "mail a b c de"), (2, None), (3, ""), (4, "w5x5 " * 3), (5, "ÜNÏ çO")]
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    named = spark.createDataFrame(items, "item_id long, text string").withColumn("terms", F.lit("x"))
    assert rows(R.ranked_search(odd_docs, named)) == brute(docs, items)
    assert R.ranked_search(odd_docs.filter("false"), named).collect() == []
    assert R.ranked_search(odd_docs, named.filter("false")).collect() == []


def test_no_accumulators_once_the_bound_is_below_the_kth_score():
    n = 400
    terms_of_docs = [np.array([0, 9] if i < 12 else [9], np.int64) for i in range(n)]
    counts = [np.ones(len(t), np.int32) for t in terms_of_docs]
    block = R.Block(None, np.full(n, 10), terms_of_docs, counts, n, 10 * n)
    acc, made = block.search(np.array([0, 9]), np.array([5000, 1]), 1, 10)
    assert made == 1 and (acc > 0).sum() == 12  # the frequent term opens none
    impact = 10**9 // (1000 + 8 * 100)
    assert set(acc[:12]) == {5001 * impact}  # but adds to the survivors exactly
    assert block.search(np.array([0, 9]), np.array([5000, 4999]), 1, 10)[1] == 1
    assert block.search(np.array([0, 9]), np.array([5000, 5000]), 1, 10)[1] == 2  # an equal score could win by its id
    assert block.search(np.array([9]), np.array([5]), 6 * impact, 10)[1] == 0  # nothing reaches the bound brought along

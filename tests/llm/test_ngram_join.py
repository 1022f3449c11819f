import re
from fractions import Fraction

import numpy as np
import pytest

from labelfold.llm import ngram_join as nj
from labelfold.llm.components import components


def grams(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[i:i + n]) for i in range(len(w) - n + 1)])


def brute(rows):
    """{(id, set): (class id, links, text links)} by comparing all pairs of sets."""
    sets = {}
    for i, t in rows:
        sets.setdefault(grams(t), []).append(i)
    keys = list(sets)
    near = {a: [b for b in keys if b != a and a and b and 5 * len(a & b) >= 4 * len(a | b)] for a in keys}
    out, lowest = {}, {}
    for a in keys:
        todo, seen = [a], {a}
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        known = [i for s in seen for i in sets[s] if i is not None]
        lowest[a] = min(known) if known else None
    for a in keys:
        for i in sets[a]:
            out[i, a] = (lowest[a], len(sets[a]) - 1 + sum(len(sets[b]) for b in near[a]), len(near[a]))
    return out


def check(df, **options):
    rows = df.select("doc_id", "text").collect()
    want = brute([(r.doc_id, r.text) for r in rows])
    expected = sorted([(r.doc_id, *want[r.doc_id, grams(r.text)]) for r in rows], key=repr)
    assert sorted(map(tuple, nj.ngram_join(df, **options).collect()), key=repr) == expected


def test_bands_reach_the_recall():
    b, r = nj.choose_bands(0.8, 0.9995)
    assert 1 - (1 - 0.8 ** r) ** b >= 0.9995 > 1 - (1 - 0.8 ** r) ** (b - 1)


@pytest.mark.parametrize("options", [{}, {"block_rows": 2, "block_grams": 500}])
def test_small_corpus(spark, options):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), **options)


def test_chain_and_large_group(spark):
    """A chain of texts each near the next only, and a group of near copies in many blocks."""
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(120)]
    rows, w = [], list(base)
    for i in range(12):
        rows.append((i, " ".join(w)))
        w = list(w)
        w[10 * i + 3] = f"new{i}"
    for i in range(150):
        x = [f"g{k}" for k in range(200)]
        x[int(rng.integers(200))] = f"z{i}"
        rows.append((100 + i, " ".join(x)))
    rows += [(500 + i, rows[0][1]) for i in range(5)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), block_rows=16)


def test_odd_rows(odd_docs):
    check(odd_docs)
    assert nj.ngram_join(odd_docs.limit(0)).count() == 0
    kept = nj.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({grams(r.text) for r in odd_docs.collect()})


def test_keep_one_keeps_the_smallest_id(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {c for c, _, _ in brute([(r.doc_id, r.text) for r in d.collect()]).values()}
    assert sorted(r.doc_id for r in nj.keep_one(d).collect()) == sorted(want)


def test_shared_grams_counts():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, size=k).astype(np.uint64)) for k in (1, 5, 30, 80, 200)]
    got = nj.shared_grams(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(5) for j in range(5) if i != j)


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_threshold_is_exact():
    """Exactly 4 of 5 is linked: no floating point at the limit."""
    a, b = np.arange(9, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64)
    z = np.zeros((2, 1), dtype=np.int64)
    got = nj.links_of_unit(0, 0, 0, np.zeros(2), [a, b], z, np.ones(2, dtype=np.int64), Fraction(4, 5))
    assert [x[1] for x in got] == [1, 1]

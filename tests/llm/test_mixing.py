from collections import defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd

from labelfold.llm import mixing
from labelfold.llm.mixing import draw_shards, mix_plan, mix_sources, permute, targets


def test_targets_by_hand():
    t = targets([100, 100, 100])
    # 450 words by 5:2:1 is 281.25 to the first, stopped at 200; 250 left by 2:1, the second 166.7
    assert t == [200, Fraction(500, 3), Fraction(250, 3)]
    assert targets([]) == [] and targets([0, 0]) == [0, 0]
    assert sum(targets([10, 0, 7, 1000, 3])) == Fraction(3, 2) * 1020


def test_permutation_is_one():
    for n in (1, 2, 3, 17, 1000, 4097):
        assert sorted(permute(np.arange(n), n, 99)) == list(range(n))


def test_draws_use_up_every_source():
    draws = draw_shards([1000, 10, 0, 333], 100, 1)
    got = defaultdict(int)
    for shard, s, first, n in draws:
        assert first == got[s]
        got[s] += n
    assert dict(got) == {0: 1000, 1: 10, 3: 333}
    assert draws == draw_shards([1000, 10, 0, 333], 100, 1)


def brute_taken(plan):
    """Words each piece gives, slot by slot."""
    slots = defaultdict(list)
    for r in plan["slots"].collect():
        slots[r.sid, r.block].append(r.take)
    out = defaultdict(int)
    for p in plan["pieces"].collect():
        out[p.sid, p.off, p.id, p.size] += sum(max(0, min(p.end, t) - p.begin) for t in slots[p.sid, p.block])
    return out


def test_documents_of_a_small_corpus(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = mix_sources(d).collect()
    assert len(rows) == d.count()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    by = defaultdict(lambda: [0, 0.0])
    texts = {r.doc_id: r for r in d.collect()}
    for r in rows:
        assert r.size == len(texts[r.doc_id].text.split())
        by[texts[r.doc_id].source][0] += r.taken
        by[texts[r.doc_id].source][1] = r.target
    assert all(abs(taken - target) <= 1 for taken, target in by.values())
    plan = mix_plan(d)
    assert sorted((k[2], v) for k, v in brute_taken(plan).items()) == sorted((r.doc_id, r.taken) for r in rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix_sources(d.repartition(5)).collect()))


def test_every_slot_is_a_block_at_most_twice(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mix_plan(d, block=64, shard_slots=50)
    seen = defaultdict(int)
    shards = set()
    for r in plan["slots"].collect():
        seen[r.sid, r.block] += 1
        shards.add(r.shard)
    assert max(seen.values()) <= 2 and len(shards) > 3


def test_repeated_and_null_ids_fill_blocks_of_their_own(spark):
    rows = [(None, "a b c", "s")] * 700 + [(7, "a b c d", "s")] * 300 + [(i, "x " * (i % 9), "s") for i in range(200)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mix_plan(d, block=16, bucket_rows=50)
    words = sorted((p.block * 16 + p.begin, p.block * 16 + p.end) for p in plan["pieces"].collect())
    assert [a for a, _ in words] == [0] + [b for _, b in words][:-1]  # no gap, no overlap
    assert words[-1][1] == sum(len(t.split()) for _, t, _ in rows)
    got = mix_sources(d, block=16, bucket_rows=50).collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r.size for r in got)
    assert sum(r.taken for r in got) == round(got[0].target)


def test_slots_are_made_in_parts(monkeypatch):
    parts = [pd.DataFrame([(0, 0, 0, 50, 900, 1300)], columns=["shard", "sid", "first", "count", "size", "quota"])]
    whole = next(mixing._slots(16, 20)(iter(parts)))
    monkeypatch.setattr(mixing, "SLOT_ROWS", 7)
    cut = list(mixing._slots(16, 20)(iter(parts)))
    assert len(cut) == 8 and [tuple(r) for p in cut for r in p.itertuples(index=False)] == list(whole.itertuples(index=False, name=None))


def test_odd_rows(odd_docs):
    rows = mix_sources(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.taken <= 2 * r.size for r in rows) and all(r.taken == 0 for r in rows if r.size == 0)
    assert mix_sources(odd_docs.limit(0)).count() == 0

import re
from collections import Counter

from pyspark.sql import functions as F

from labelfold.llm import decontam as dc


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def grams(w):
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def brute(text, items):
    """Items found by sliding every window of the item's size that lines up with one of its shingles."""
    d, hits = grams(words(text)), set()
    for key, item in items:
        g = grams(words(item))
        starts = {p - q for p, x in enumerate(d) for q, y in enumerate(g) if x == y}
        for s in starts:
            a, b = Counter(d[max(s, 0):min(s + len(g), len(d))]), Counter(g)
            if 5 * sum((a & b).values()) >= 4 * sum((a | b).values()):
                hits.add(key)
    return sorted(hits)


ITEM = "The quick brown fox jumps over the lazy dog while twelve small birds sing a quiet song about the long river"
TEXTS = [ITEM, "before " + ITEM.upper() + " after", ITEM.replace(" ", ", "), ITEM.replace("lazy", "sleepy"),
         ITEM.replace("lazy", "sleepy").replace("quiet", "loud"), " ".join(ITEM.split()[:14]), ITEM + " " + ITEM,
         " ".join(ITEM.split()[2:]), "nothing of the kind stands in this clean text at all", None, "", "a b", "x " * 50]


def test_against_brute_force(spark):
    items = [(1, ITEM), (2, "x " * 12), (3, "too short"), (4, None), (5, ITEM)]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in dc.decontaminate(docs, bench).collect()}
    assert got == {i: brute(t, items) for i, t in enumerate(TEXTS)}
    assert got[0] == [1, 5] and got[8] == []
    several = {r.doc_id: r.item_ids for r in dc.decontaminate(docs, bench, broadcast_rows=7).collect()}
    assert several == got


def test_real_tables(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    b = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in b.collect()]
    got = {r.doc_id: r.item_ids for r in dc.decontaminate(d, b).collect()}
    assert got == {r.doc_id: brute(r.text, items) for r in d.collect()}
    kept = dc.keep_clean(d, b)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, x in got.items() if not x)


def mix(x, k):
    """xxhash64 of a long and an int, as Spark makes it."""
    import struct

    import xxhash
    h = xxhash.xxh64(struct.pack("<q", x), seed=42).intdigest()
    return xxhash.xxh64(struct.pack("<i", k), seed=h).intdigest()


def fingerprint(hashes):
    words = []
    for k in range(dc.PRINT_WORDS):
        own, word = [x % (1 << 64) if k == 0 else mix(x, k) for x in hashes], 0
        for b in range(64):
            if sum(1 if (x >> b) & 1 else -1 for x in own) > 0:
                word |= 1 << b
        words.append(word)
    return words


def test_simhash(spark):
    h = [5, -9, 5, 123456789012345]
    row = spark.createDataFrame([(h, [1, 2, 3, -1], [1, 2, 0, -2])], "h array<bigint>, a array<bigint>, b array<bigint>").select(
        dc.simhash("h").alias("s"), dc.hamming("a", "b").alias("d")).first()
    assert [x % (1 << 64) for x in row.s] == fingerprint(h) and row.d == 3


def test_the_radius_loses_nothing_at_the_threshold():
    """Simulated windows of just similarity 0.8, and unrelated ones, by their random bits."""
    import numpy as np
    rng = np.random.default_rng(6)

    def bits(n, rows):
        return 2 * rng.integers(0, 2, size=(rows, n, 256), dtype=np.int8) - 1

    def prints(x):
        return x.sum(axis=1, dtype=np.int16) > 0
    worst, apart = 0, []
    for n, kept, rounds in ((5, 4, 60), (9, 8, 30), (45, 40, 10)):  # kept of n shingles in both, similarity 0.8 to 0.82
        for _ in range(rounds):
            a = bits(n, 1000)
            other = np.concatenate([a[:, :kept], bits(n - kept, 1000)], axis=1) if n > 9 else a[:, :kept]
            worst = max(worst, int((prints(a) != prints(other)).sum(axis=1).max()))
            apart.append((prints(a)[:-1] != prints(a)[1:]).sum(axis=1).min())
    assert worst <= dc.RADIUS
    assert min(apart) > dc.RADIUS - 10 and np.mean(np.array(apart) <= dc.RADIUS) < 0.1


def test_many_items_of_one_size_do_not_meet(spark):
    """10 000 items of one size: windows meet the items that they share a chosen shingle with, and no other."""
    import random
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=20))) for i in range(10_000)]
    # a template that all others share but for their last words has no rare shingle besides those
    docs = [(i, f"start {items[i * 50][1]} end") for i in range(200)] + [(500, " ".join(items[3][1].split()[:12]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = dc.item_table(bench)
    own = spark.createDataFrame(docs, "id long, text string").withColumn("th", F.unhex(F.md5("text")))
    windows = dc.find_windows(own, table, dc.THRESHOLD, dc.BROADCAST_ROWS)
    met = dc.meeting_pairs(windows, table)
    n, pairs = windows.count(), met.count()
    within = met.filter(dc.hamming("print", "item_print") <= dc.RADIUS).count()
    assert n >= 200 and pairs < 0.01 * n * len(items) and pairs <= 2 * n and 200 <= within <= 210
    hits = dc.find_hits(spark.createDataFrame(docs, "doc_id long, text string"), bench).select("id", "item").distinct().collect()
    assert sorted(hits) == [(i, i * 50) for i in range(200)]


def test_chosen_shingles_are_more_than_may_be_missed(spark):
    items = [(1, ITEM), (2, "a b c d e"), (3, "x " * 12), (4, "x " * 12)]
    table = dc.item_table(spark.createDataFrame(items, "item_id long, text string"))
    n = {r.item: r.n for r in dc.chosen_shingles(table, dc.THRESHOLD).join(table, "item_no").groupBy("item").count()
         .withColumnRenamed("count", "n").collect()}
    # 17 shingles may miss 3; one may miss none; a single shingle repeated is one choice
    assert n == {1: 4, 2: 1, 3: 1, 4: 1}


def test_odd_rows(spark, odd_docs):
    bench = spark.createDataFrame([(1, "one two three four five six"), (None, "three four five six seven")],
                                  "item_id long, text string")
    rows = dc.decontaminate(odd_docs, bench).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.contaminated == (r.doc_id in (1, 2)) for r in rows)
    assert dc.keep_clean(odd_docs, bench).columns == odd_docs.columns
    assert dc.decontaminate(odd_docs.limit(0), bench).count() == 0
    assert dc.decontaminate(odd_docs, bench.limit(0)).filter(F.col("contaminated")).count() == 0


def test_short_items_at_the_threshold(spark):
    """Items of five shingles of which the text's end leaves four: similarity 0.8, and fingerprints far apart."""
    import random
    rng = random.Random(3)
    items = [(i, " ".join(f"w{rng.getrandbits(40)}" for _ in range(9))) for i in range(600)]
    docs = spark.createDataFrame([(i, " ".join(t.split()[:8])) for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in dc.decontaminate(docs, bench).collect()}
    assert got == {i: [i] for i, _ in items}
    narrow = dc.decontaminate(docs, bench, radius=19).filter("contaminated").count()
    assert narrow < len(items)

import hashlib
import re
from collections import defaultdict

from labelfold.llm.exact_dedup import exact_dedup, keep_first


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_against_brute_force(odd_docs):
    got = sorted(map(tuple, exact_dedup(odd_docs).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()])


def test_keep_first_returns_one_row_a_group_with_its_columns(odd_docs):
    kept = keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
                                                 for r in odd_docs.collect()})


def test_empty(odd_docs):
    assert exact_dedup(odd_docs.limit(0)).count() == 0
    assert keep_first(odd_docs.limit(0)).count() == 0


def test_equal_hashes_of_different_texts_stay_apart(spark, monkeypatch):
    """With a hash that always collides the byte comparison alone separates texts."""
    from pyspark.sql import functions as F

    import labelfold.llm.exact_dedup as m
    monkeypatch.setattr(m.F, "md5", lambda c: F.lit("00" * 16))
    d = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(d).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2)}


def test_hot_group(spark):
    from pyspark.sql import functions as F
    d = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(
        F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    got = exact_dedup(d)
    assert got.count() == 20_000 and got.filter("group_size = 6667").count() == 6667

import corpus_pipeline as cp

from labelfold.llm import pu_quality
from labelfold.session import read_table
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_exact_dedup import brute as copies
from tests.llm.test_ngram_join import brute as near

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    scores = pu_quality.score_quality(docs, read_table(spark, SF, "labels"))
    want = {r.doc_id for r in scores.collect() if r.predicted}
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    steps = {
        "quality": lambda ids: want,
        "exact_copies": lambda ids: {i for i, keep, *_ in copies([(i, texts[i]) for i in ids]) if i == keep},
        "near_copies": lambda ids: {c for c, _, _ in near([(i, texts[i]) for i in ids]).values()},
        "benchmark_passages": lambda ids: {i for i in ids if not leaks(texts[i], items)},
    }
    ids, before = set(texts), None
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        if name == "mix":
            assert sorted(r.doc_id for r in out.collect()) == sorted(ids)
            break
        assert out.columns == columns
        docs = out.select(*columns)
        before, ids = ids, steps[name](ids)
        assert sorted(r.doc_id for r in docs.collect()) == sorted(ids), name
        assert ids <= before
    assert len(ids) < len(texts)


def test_run(spark):
    rows = cp.run(spark, SF).collect()
    assert rows and {"doc_id", "size", "taken"} <= set(rows[0].asDict())
    assert sorted(map(tuple, rows)) == sorted(map(tuple, cp.run(spark, SF).collect()))


def test_odd_rows(spark, odd_docs):
    docs = odd_docs
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() > 0
    empty = odd_docs.limit(0)
    for name, stage in cp.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0

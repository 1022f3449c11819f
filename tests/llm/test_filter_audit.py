from itertools import permutations

from pyspark.sql import functions as F

from labelfold.llm import filter_audit as A

METRICS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def mask(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    return ((len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words))
            + 4 * (100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text)) + 8 * any(c in "#$%&*|" for c in text))


def brute(docs, labels):
    """Rows by applying every order to every document; docs (id, text, source), labels (id, quality, toxic)."""
    failed = []
    for i, t, s in docs:
        dup = i is not None and any(j is not None and j < i and (u or "") == (t or "") for j, u, _ in docs)
        marks = [(q, x) for j, q, x in labels if j is not None and j == i]
        failed.append((s or "", mask(t or "") + 16 * dup, any(q == 1 for q, _ in marks), any(x == 1 for _, x in marks)))
    out = {}
    for part in {f[0] for f in failed}:
        own, shapley = [f for f in failed if f[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            before = 0
            for step, letter in enumerate(order):
                bit = 1 << "ABCDE".index(letter)
                gone = [f for f in own if f[1] & bit and not f[1] & before]
                out[part, "".join(order), step + 1] = [
                    sum(not f[1] & (before | bit) for f in own), len(gone), sum(bool(f[1] & bit and f[1] & before) for f in own),
                    sum(f[1] == bit for f in own), sum(f[2] for f in gone), sum(f[3] for f in gone)]
                shapley[letter] += len(gone)
                before |= bit
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def rows(df):
    got = {(r.part, r.filter_order, r.step): [r[m] for m in METRICS] for r in df.collect()}
    assert len(got) % 600 == 0
    return got


def test_odd_rows_against_brute_force(spark, odd_docs):
    more = [(20, "LOUD " * 60, "en", "b"), (21, "a $ b", "en", "b"), (22, "a $ b", "en", "c"), (22, "a $ b", "en", "b"),
            (None, "a $ b", "en", "b"), (-5, "words " * 70, "en", None), (30, " ".join(f"w{i}" for i in range(80)), "en", "b")]
    docs = odd_docs.select("doc_id", "text", "lang", "source").union(
        spark.createDataFrame(more, "doc_id long, text string, lang string, source string"))
    docs = docs.select("*", *[F.lit("x").alias(c) for c in ("id", "part", "th", "mask", "good", "toxic", "salt", "n", "step")])
    marks = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (20, 1, 1), (21, None, 1), (None, 1, 1), (22, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))
    plain = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    want = brute(plain, marks)
    assert rows(A.audit_filters(docs, labels)) == want
    assert rows(A.audit_filters(docs, labels.filter("false"))) == brute(plain, [])
    assert A.audit_filters(docs.filter("false"), labels).collect() == []


def test_many_parts_take_several_recursions(spark, monkeypatch):
    cells = spark.createDataFrame([(f"p{i}", i % 32, i % 2 == 0, i % 3 == 0, i + 1) for i in range(40)],
                                  "part string, mask int, good boolean, toxic boolean, n long")
    whole = rows(A.audit_orders(cells))
    monkeypatch.setattr(A, "RECURSION_ROWS", 3000)
    assert rows(A.audit_orders(cells)) == whole and len(whole) == 40 * 600


def test_a_hot_text_is_few_rows(spark):
    n = 3000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same $").otherwise(
        F.concat(F.lit("t"), F.col("id"))).alias("text"), (F.col("id") % 2).cast("string").alias("source"))
    labels = spark.createDataFrame([(0, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    got = {(r.part, r["mask"], r.good, r.toxic): r.n for r in A.filter_cells(docs, labels).collect()}
    assert got == {("0", 9, True, False): 1, ("1", 25, True, True): 1, ("0", 25, False, False): 499,
                   ("1", 25, False, False): 499, ("0", 1, False, False): 1000, ("1", 1, False, False): 1000}

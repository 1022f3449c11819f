"""Operator 12: ranked lexical search by accumulator-limited term-at-a-time scoring.

Terms, statistics and scores are integers as the contract gives them: a term weighs
w = floor(1000 ln((2N + 2) / (2 df + 1))), a document's length gives
m = 25 + 75 n N div L, and a posting's impact is 10^9 tf div (1000 tf + 8 m).

1. Items are cut into terms; the different ones are the vocabulary, a written table.
2. One pass over the documents counts each text's terms and keeps those of the
   vocabulary: (id, n, terms, counts) is the written forward index.  N and L, and the
   df of every term, are aggregates over it.
3. The index is read in blocks of bounded size.  A block is turned into postings by
   term, and every item is scored over it term at a time, rarest first.  While
   new accumulators are made, each term's postings open one per document.  Once the
   remaining terms together (weight x largest impact in the block) stay below the
   item's k-th partial score, no document without accumulator can reach the top k:
   no more are made, and the remaining terms update the survivors exactly.  The k-th
   score of earlier blocks of the task is a lower bound from the start.
4. A block gives at most k rows per item; one window ranks them.

Nothing here grows with the corpus but the blocks' number: a term that every document
holds is one posting per document of a block, and a third of all documents being equal
gives ties, cut by (score, id) in each block.  Items are streamed past a block from
their written table.  The vocabulary stands in every worker, so it is bounded: items
with more than ``vocabulary_rows`` terms together are searched in several groups.

Defined results: null and empty texts have no terms and are not counted in N; an item
without known terms gives no rows; rows that repeat an id are documents (or items)
each, ranked apart; equal scores go by ascending id, a null id last; one very long
text is one document of its block; empty tables give no rows; other columns are never
read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelfold.llm.common import text_of, through_table
from labelfold.llm.shards import record_batches

# Fixed value: a term is a run of these; the control, punctuation and symbol characters of ASCII end it.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 10
#: A block ends at so many documents or postings.
BLOCK_DOCS, BLOCK_POSTINGS = 16_384, 4_000_000
#: Different terms that stand in a worker at most (about 100 bytes each).
VOCABULARY_ROWS = 1_000_000


def terms_of(text: Column) -> Column:
    """The terms of a text in order, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def _index_documents(vocabulary: str):
    """(id, text) batches -> (id, n, terms, counts) of texts with a term."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        number = {}
        for b in record_batches(vocabulary, ["term", "term_no"]):
            number.update(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        find, known = re.compile(TERM).findall, number.get
        lower = re.compile("[A-Z]+").sub
        for batch in batches:
            keep, sizes, terms, counts = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                words = find(lower(lambda m: m.group().lower(), text.as_py() or ""))
                if words:
                    got, c = np.unique(np.fromiter((x for x in map(known, words) if x is not None), np.int32),
                                       return_counts=True)
                    keep.append(i)
                    sizes.append(len(words))
                    terms.append(got)
                    counts.append(c)
            ends = pa.array(np.cumsum([0, *map(len, terms)]), pa.int32())
            flat = lambda x: pa.array(np.concatenate([np.empty(0, np.int32), *x]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, flat(terms)), pa.ListArray.from_arrays(ends, flat(counts))],
                names=["id", "n", "terms", "counts"])
    return run


class Block:
    """Postings of a run of documents, by term."""

    def __init__(self, ids, n, terms, counts, docs_total: int, words_total: int):
        import numpy as np

        self.ids, self.size = ids, len(n)
        m = 25 + (75 * n * docs_total) // words_total
        doc = np.repeat(np.arange(self.size), [len(t) for t in terms])
        term, tf = np.concatenate(terms), np.concatenate(counts).astype(np.int64)
        order = np.argsort(term, kind="stable")
        self.docs = doc[order]
        self.impact = ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))[order]
        self.terms, self.starts = np.unique(term[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))
        self.best = np.maximum.reduceat(self.impact, self.starts) if len(order) else self.impact

    def postings(self, terms):
        """(place among the block's terms, whether it is there) of every term."""
        import numpy as np

        at = np.minimum(np.searchsorted(self.terms, terms), max(len(self.terms) - 1, 0))
        return at, (self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool))

    def search(self, terms, weights, least: int, k: int):
        """Accumulators and the number of terms that made new ones; ``terms`` rarest first.

        ``least`` is a score that a document must reach."""
        import numpy as np

        at, there = self.postings(terms)
        at, weights = at[there], weights[there]
        bounds = weights * self.best[at]
        left = bounds[::-1].cumsum()[::-1]  # what the terms from here on can give at most
        acc, alive, made = np.zeros(self.size, np.int64), None, 0
        for i, (a, w) in enumerate(zip(at, weights)):
            if alive is None and left[i] < max(least, acc.max(initial=0)):
                kth = np.partition(acc, -k)[-k] if self.size >= k else 0
                if left[i] < max(least, kth):
                    alive = acc + left[i] >= max(least, kth)  # survivors; the others cannot come back
                    alive &= acc > 0
            docs, impact = self.docs[self.starts[a]:self.ends[a]], self.impact[self.starts[a]:self.ends[a]]
            if alive is None:
                acc[docs] += w * impact
                made += 1
            else:
                on = alive[docs]
                acc[docs[on]] += w * impact[on]
        if alive is not None:
            acc[~alive] = 0
        return acc, made


def _search_blocks(items: str, docs_total: int, words_total: int, k: int, block_docs: int, block_postings: int):
    """Index batches -> (item, id, score), at most k per item and block."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        kept = {}  # item -> the k best scores so far in this task

        def results(rows):
            ids, n, terms, counts = zip(*rows)
            block = Block(pa.chunked_array(ids), np.concatenate(n), sum(terms, []), sum(counts, []), docs_total, words_total)
            place = np.asarray(pc.rank(block.ids, null_placement="at_end", tiebreaker="first")).astype(np.int64)
            for batch in record_batches(items, ["item_no", "terms", "weights"], 512):
                rows, items_no, best = [], [], []
                for item, t, w in zip(*(c.to_numpy(zero_copy_only=False) for c in batch.columns)):
                    scores = kept.get(item, np.empty(0, np.int64))
                    least = max(int(scores[-1]), 1) if len(scores) == k else 1
                    acc, _ = block.search(t, w, least, k)
                    hit = np.flatnonzero(acc >= least)
                    if len(hit) > k:  # the k-th score's ties all stay until their ids are compared
                        hit = hit[acc[hit] >= np.partition(acc[hit], -k)[-k]]
                    if len(hit):
                        hit = hit[np.lexsort((place[hit], -acc[hit]))][:k]
                        kept[item] = np.sort(np.append(scores, acc[hit]))[::-1][:k]
                        rows.append(hit)
                        items_no.append(np.full(len(hit), item))
                        best.append(acc[hit])
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(items_no), pa.int64()),
                         block.ids.take(pa.array(np.concatenate(rows))).combine_chunks(),
                         pa.array(np.concatenate(best), pa.int64())], names=["item_no", "id", "score"])

        held, docs, postings = [], 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                terms, counts = ([x for x in part.column(i).to_numpy(zero_copy_only=False)] for i in (2, 3))
                held.append((part.column(0), part.column(1).to_numpy(), terms, counts))
                docs += part.num_rows
                postings += sum(map(len, terms))
                if docs >= block_docs or postings >= block_postings:
                    yield from results(held)
                    held, docs, postings = [], 0, 0
        if held:
            yield from results(held)
    return run


def _search_group(docs: DataFrame, wanted: DataFrame, k: int, block_docs: int, block_postings: int) -> DataFrame:
    """(item_no, id, score): the best of every block for a group of items, given as (item_no, term, times)."""
    spark, id_type = docs.sparkSession, docs.schema["id"].dataType
    vocabulary = through_table(wanted.select("term").distinct().withColumn(
        "term_no", F.row_number().over(Window.orderBy("term"))), "vocabulary")
    where = vocabulary.inputFiles()
    if not where:
        return None
    schema = T.StructType([T.StructField("id", id_type), T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("counts", T.ArrayType(T.IntegerType()))])
    index = through_table(docs.mapInArrow(_index_documents(where[0].rsplit("/", 1)[0]), schema), "forward-index")
    total = index.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    if not total["n"]:
        return None
    df = index.select(F.explode("terms").alias("term_no")).groupBy("term_no").agg(F.count(F.lit(1)).alias("df"))
    known = (vocabulary.join(df, "term_no").select(
        "term", "term_no", "df", F.floor(F.log((2 * F.lit(total["n"]) + 2) / (2 * F.col("df") + 1)) * 1000).alias("w")))
    items = through_table(
        wanted.join(known, "term").groupBy("item_no")
        .agg(F.sort_array(F.collect_list(F.struct("df", "term_no", (F.col("w") * F.col("times")).alias("w")))).alias("t"))
        .select("item_no", F.col("t.term_no").alias("terms"), F.col("t.w").alias("weights")), "items")
    where = items.inputFiles()
    if not where:
        return None
    found = T.StructType([T.StructField("item_no", T.LongType()), T.StructField("id", id_type), T.StructField("score", T.LongType())])
    return index.mapInArrow(_search_blocks(where[0].rsplit("/", 1)[0], total["n"], total["l"], k, block_docs, block_postings),
                            found)


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", k: int = TOP, block_docs: int = BLOCK_DOCS,
                  block_postings: int = BLOCK_POSTINGS, vocabulary_rows: int = VOCABULARY_ROWS) -> DataFrame:
    """(item, rank, id, score): the k best documents with a score above 0 of every item."""
    # items get numbers, so that repeated ids stay apart; written, so that they keep them
    named = through_table(items.select(F.col(item_col).alias("item"), terms_of(text_of(item_text_col)).alias("terms"))
                          .withColumn("item_no", F.monotonically_increasing_id()), "named-items")
    wanted = through_table(named.select("item_no", F.explode("terms").alias("term")).groupBy("item_no", "term")
                           .agg(F.count(F.lit(1)).alias("times")), "item-terms")
    d = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    groups = max(1, -(-wanted.count() // vocabulary_rows))
    best = None
    for g in range(groups):
        own = wanted if groups == 1 else wanted.filter(F.pmod(F.xxhash64("item_no"), F.lit(groups)) == g)
        found = _search_group(d, own, k, block_docs, block_postings)
        best = best if found is None else found if best is None else best.unionByName(found)
    if best is None:
        best = d.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item_no", T.LongType()), T.StructField("id", d.schema["id"].dataType), T.StructField("score", T.LongType())]))
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).join(named, "item_no")
            .select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"))


RANKED_SEARCH_SQL = r"""
WITH i AS (SELECT row_number() OVER () AS no, item_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
q AS (SELECT no, item_id, term, count(*) AS times FROM (SELECT no, item_id, unnest(ts) AS term FROM i) GROUP BY ALL),
tot AS (SELECT count(*) AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
p AS (SELECT row, doc_id, size, term, count(*) AS tf
      FROM (SELECT row, doc_id, len(ts) AS size, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM p GROUP BY 1) CROSS JOIN tot),
s AS (SELECT no, item_id, row, doc_id,
             sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * size * n) // l))))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term) CROSS JOIN tot GROUP BY 1, 2, 3, 4)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""

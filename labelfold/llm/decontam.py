"""Operator 2: benchmark decontamination by SimHash item-sized windows.

Words are runs of letters and digits, lower-cased; a shingle is a run of five
words.  For every benchmark item, windows of the item's size are laid over each
document wherever one of its shingles would line up with the same shingle of
some item; no other window can share enough with an item.  Each window and each
item gets a 256-bit SimHash of its weighted shingles (weight: how often it
occurs).  A window meets an item of its size within Hamming distance ``RADIUS``,
and the pairs are verified by the exact weighted Jaccard similarity of the
shingles: ``threshold`` or more is contamination.

The index that brings a window to its items is not one of Hamming blocks.  At
similarity 0.8 a bit differs with probability 0.15 to 0.19 and the radius must be a
quarter to a third of the bits, and for such a radius blocks that guarantee it do not
select (figures in README.md).  It is a guarantee of another kind: a window that has
the threshold's share of an item misses at most (1 - threshold) of the item's
shingles, so it holds one of any larger choice of them.  Chosen are those that the
fewest items hold, and a document's windows meet only the items of which the document
holds a chosen shingle.  No pair above the threshold is missed by it, and unrelated
items of one size never meet.

Everything runs as SQL expressions.  Documents are read once; their shingle hashes
meet the item shingles by a broadcast join of checked size, and only the windows found
carry their shingles on.  With a larger benchmark (place, shingle) rows meet the item
shingles by a shuffle join on the shingle instead, and the texts that hold one are read
once more to cut the windows, however many shingles the benchmark has.  A passage that a
third of all documents share is as many narrow rows.

Defined results: null texts and texts of fewer than five words have no shingles
and are clean; an item of fewer than five words matches nothing; a null id is a
document like any other; rows that repeat id and text are judged alike, rows that
repeat the id alone by their own texts; equal items are each reported; an item
with a null id taints but is not listed; a similarity of just the threshold counts;
one very long text gives as many windows as it has shared shingles; empty tables give
clean documents or none; other columns are never read.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelfold.llm.common import text_of, through_table

WORDS, THRESHOLD = 5, Fraction(4, 5)
#: Words of the fingerprint, and the Hamming radius.  At similarity 0.8 a bit differs with probability 0.15 among
#: many shingles and 0.19 where 4 of 5 are left: 39 and 49 of 256 bits on average, 8 and 6 deviations below the
#: radius.  Unrelated fingerprints differ in 128 bits, 5 deviations above it (3e-7 of them come within).
PRINT_WORDS, RADIUS = 4, 88
#: Item shingles broadcast at most (about 60 bytes each).
BROADCAST_ROWS = 500_000


def word_hashes(text_col: str) -> Column:
    """Hashes of the words, in order."""
    words = F.regexp_extract_all(F.lower(text_of(text_col)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_at(hashes: Column, pos: Column) -> Column:
    """The hash of the five words from a place on; null where fewer stand."""
    return F.when(pos + (WORDS - 1) < F.size(hashes), F.xxhash64(*[F.get(hashes, pos + k) for k in range(WORDS)]))


def shingles(hashes: str) -> Column:
    """All shingles of an array of word hashes, in order."""
    return F.when(F.size(hashes) >= WORDS, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - WORDS), lambda i: shingle_at(F.col(hashes), i))).otherwise(
        F.array().cast("array<bigint>"))


def simhash(hashes: str) -> Column:
    """SimHash of an array of shingle hashes as PRINT_WORDS longs, repeats weighing more."""
    words = [f"""aggregate(transform(sequence(0, 63), b ->
        if(aggregate(w{k}, 0, (n, x) -> n + if((shiftright(x, b) & 1L) = 1L, 1, -1)) > 0,
           shiftleft(1L, b), 0L)), 0L, (a, x) -> a | x)""" for k in range(PRINT_WORDS)]
    mixed = [f"transform({hashes}, x -> {'x' if k == 0 else f'xxhash64(x, {k})'})" for k in range(PRINT_WORDS)]
    for k in range(PRINT_WORDS):  # each word's hashes are made once, as the only element of an array
        words[k] = f"transform(array({mixed[k]}), w{k} -> {words[k]})[0]"
    return F.expr(f"array({', '.join(words)})")


def hamming(a: str, b: str) -> Column:
    """Bits in which two fingerprints differ."""
    return F.expr(" + ".join(f"bit_count({a}[{k}] ^ {b}[{k}])" for k in range(PRINT_WORDS)))


def chosen_shingles(items: DataFrame, threshold: Fraction) -> DataFrame:
    """(gram, size, item_no): of every item the shingles that the fewest items hold, one more than it may miss."""
    each = items.select("item_no", "size", F.explode("grams").alias("gram"))
    held = each.groupBy("gram").agg(F.countDistinct("item_no").alias("held"))
    ranked = each.join(held, "gram").withColumn(
        "r", F.row_number().over(Window.partitionBy("item_no").orderBy("held", "gram")))
    may_miss = F.floor(F.col("size") * (threshold.denominator - threshold.numerator) / threshold.denominator)
    return ranked.filter(F.col("r") <= may_miss + 1).select("gram", "size", "item_no").distinct()


def shared_weight(a: str, b: str) -> Column:
    """Sum over shingles of the smaller of their two counts."""
    return F.expr(f"""CASE
        WHEN size(array_distinct({a})) = size({a}) AND size(array_distinct({b})) = size({b})
          THEN size(array_intersect({a}, {b}))
        ELSE aggregate(array_intersect({a}, {b}), 0, (n, g) ->
          n + least(size(filter({a}, x -> x = g)), size(filter({b}, x -> x = g)))) END""")


def item_table(benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_no, item, item_key, grams, size, print) of the items with a shingle, written."""
    return through_table(
        benchmark.select(F.col(item_col).alias("item"), text_of(item_text_col).alias("text"))
        .select("item", F.unhex(F.md5("text")).alias("item_key"), word_hashes("text").alias("hashes"))
        .select("item", "item_key", shingles("hashes").alias("grams")).filter("size(grams) > 0")
        .withColumn("size", F.size("grams")).withColumn("print", simhash("grams"))
        .withColumn("item_no", F.monotonically_increasing_id()), "items")


def find_windows(docs: DataFrame, items: DataFrame, threshold: Fraction, broadcast_rows: int) -> DataFrame:
    """(id, th, size, begin, own, print, linked): item-sized windows, and the items that their document may hold."""
    # every (gram, size, place) once; the items that chose a gram stand at one of its places
    seeds = items.select("size", F.posexplode("grams").alias("at", "gram")).distinct()
    links = chosen_shingles(items, threshold).groupBy("gram", "size").agg(F.collect_set("item_no").alias("linked"))
    first = seeds.groupBy("gram", "size").agg(F.min("at").alias("at")).join(links, ["gram", "size"])
    seeds = through_table(seeds.join(first, ["gram", "size", "at"], "left"), "seeds")

    d = docs.select("id", "th", word_hashes("text").alias("hashes"))
    # every place is made and hashed in one stage of generated code; only hits become rows
    placed = d.select("id", "th", "hashes", F.posexplode_outer("hashes").alias("pos", "word")).withColumn(
        "gram", shingle_at(F.col("hashes"), F.col("pos")))
    start = (F.col("pos") - F.col("at")).alias("start")
    near = F.expr("slice(hashes, greatest(start, 0) + 1, least(start, 0) + size + 4)").alias("near")
    if seeds.count() <= broadcast_rows:
        found = (placed.join(F.broadcast(seeds), "gram").select("id", "th", "size", start, "hashes", "linked")
                 .select("id", "th", "size", "start", "linked", near))
    else:
        hits = (placed.filter("gram IS NOT NULL").select("id", "th", "pos", "gram").join(seeds, "gram")
                .select("id", "th", "size", start, "linked").groupBy("id", "th", "size", "start")
                .agg(F.array_distinct(F.flatten(F.collect_list("linked"))).alias("linked")))
        found = (hits.withColumnsRenamed({"id": "hid", "th": "hth"})
                 .join(d.dropDuplicates(["id", "th"]), F.expr("hid <=> id AND hth = th"))
                 .select("id", "th", "size", "start", "linked", near))
    windows = through_table(
        found.groupBy("id", "th", "size", "start").agg(
            F.first("near").alias("near"), F.array_distinct(F.flatten(F.collect_list("linked"))).alias("linked"))
        .select("id", "th", "size", F.greatest("start", F.lit(0)).alias("begin"), shingles("near").alias("own"), "linked")
        .withColumn("print", simhash("own")), "windows")
    return windows


def meeting_pairs(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Windows with the items of their size that their document is linked to."""
    linked = windows.select("id", "th", "size", F.explode("linked").alias("item_no")).distinct()
    linked = linked.withColumnsRenamed({"id": "lid", "th": "lth", "size": "lsize"})
    met = (windows.drop("linked").join(linked, F.expr("id <=> lid AND th = lth AND size = lsize")).drop("lid", "lth", "lsize"))
    return met.join(items.withColumnRenamed("print", "item_print").drop("size"), "item_no")


def find_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", threshold: Fraction = THRESHOLD,
              radius: int = RADIUS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Verified windows: id, th (128-bit hash of the text), item, item_key, begin (word), words, similarity."""
    items = item_table(benchmark, item_col, item_text_col)
    own = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text_of(text_col))).alias("th"), text_of(text_col).alias("text"))
    windows = find_windows(own, items, threshold, broadcast_rows)
    candidates = meeting_pairs(windows, items).filter(hamming("print", "item_print") <= radius)
    t = threshold
    return (candidates.withColumn("shared", shared_weight("own", "grams"))
            .withColumn("all", F.expr("size(own) + size(grams) - shared"))
            .filter(F.col("shared") * t.denominator >= F.col("all") * t.numerator)
            .select("id", "th", "item", "item_key", "begin", (F.col("size") + WORDS - 1).alias("words"),
                    (F.col("shared") / F.col("all")).alias("similarity")))


def _per_document(hits: DataFrame) -> DataFrame:
    return hits.groupBy("id", "th").agg(
        F.sort_array(F.collect_set("item")).alias("item_ids"), F.max("similarity").alias("similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """One row per document: id, contaminated, n_items, item_ids (sorted), similarity (the best)."""
    hits = through_table(_per_document(find_hits(docs, benchmark, id_col, text_col, **options)), "hits")
    rows = docs.select(F.col(id_col).alias("rid"), F.unhex(F.md5(text_of(text_col))).alias("rth"))
    return (rows.join(hits, F.col("rid").eqNullSafe(F.col("id")) & (F.col("rth") == F.col("th")), "left")
            .select(F.col("rid").alias(id_col), F.col("th").isNotNull().alias("contaminated"),
                    F.when(F.col("th").isNull(), F.lit(0)).otherwise(F.size("item_ids")).cast("long").alias("n_items"),
                    F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
                    F.coalesce("similarity", F.lit(0.0)).alias("similarity")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """The documents without contamination, with all their columns."""
    hits = through_table(find_hits(docs, benchmark, id_col, text_col, **options).select("id", "th").distinct(),
                         "hits")
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)],
                      F.col(id_col).alias("rid"), F.unhex(F.md5(text_of(text_col))).alias("rth"))
    return (own.join(hits, F.col("rid").eqNullSafe(F.col("id")) & (F.col("rth") == F.col("th")), "left_anti")
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]))


# every window that lines up with an item's shingle, verified exactly; no fingerprints
DECONTAM_SQL = r"""
WITH i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM benchmark),
ig AS (SELECT item_id, len(ws) - 4 AS size, unnest(range(1, len(ws) - 3)) AS pos, ws FROM i WHERE len(ws) >= 5),
ia AS (SELECT item_id, size, pos, array_to_string(ws[pos:pos + 4], ' ') AS gram FROM ig),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents),
dg AS (SELECT doc_id, len(ws) - 4 AS n, unnest(range(1, len(ws) - 3)) AS pos, ws FROM d WHERE len(ws) >= 5),
da AS (SELECT doc_id, n, pos, array_to_string(ws[pos:pos + 4], ' ') AS gram FROM dg),
win AS (SELECT DISTINCT doc_id, n, size, greatest(da.pos - ia.pos, 0) AS begin, least(da.pos - ia.pos + size, n) AS stop
        FROM da JOIN ia USING (gram)),
wc AS (SELECT win.doc_id, win.size, win.begin, win.stop, da.gram, count(*) AS c
       FROM win JOIN da ON da.doc_id = win.doc_id AND da.pos > win.begin AND da.pos <= win.stop GROUP BY ALL),
ic AS (SELECT item_id, size, gram, count(*) AS c FROM ia GROUP BY ALL),
m AS (SELECT wc.doc_id, wc.begin, ic.item_id, any_value(wc.stop - wc.begin + wc.size) AS total,
             sum(least(wc.c, ic.c)) AS shared
      FROM wc JOIN ic USING (size, gram) GROUP BY 1, 2, 3),
hit AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS item_ids, max(shared / (total - shared)) AS similarity
        FROM m WHERE shared * 5 >= 4 * (total - shared) GROUP BY 1)
SELECT documents.doc_id, hit.doc_id IS NOT NULL AS contaminated, coalesce(len(item_ids), 0) AS n_items,
       coalesce(item_ids, []::BIGINT[]) AS item_ids, coalesce(similarity, 0.0)::DOUBLE AS similarity
FROM documents LEFT JOIN hit USING (doc_id)
"""

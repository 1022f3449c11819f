"""Operator 5: n-gram Jaccard self-join by MinHash banding, verified on full sets.

Words are runs of characters other than white space; a text's set holds its
distinct runs of ``n`` words (a text of fewer words is one such run).  Two texts
are linked when the Jaccard similarity of their sets reaches ``threshold``.

1. One pass hashes every whole text to its set's 128-bit key and band hashes.
   :func:`choose_bands` picks the fewest bands that reach the target recall at
   the threshold.  Texts with the same set collapse to one member per key, on
   the map side first.
2. Members meet on band hashes (16 + 8 bytes a row).  Buckets of one member go;
   buckets with the same members, told by count and two xor checksums, are one.
3. Full sets are made only for members of the remaining buckets, whose texts are
   fetched by id and hash.
4. A bucket is split into blocks (at most about ``block_rows`` members and
   ``block_grams`` n-grams); each pair of blocks is one unit of work, compared
   inside a task by a sparse-column product.  A pair of texts is counted in the
   first band it shares, so nothing is counted twice.  A unit returns one row
   per linked member (its numbers of links, and its component's smallest key),
   never the pairs.  No partner or candidate is dropped: a large bucket only
   has more units, spread over all tasks.
5. Components of those rows give every text its class.

The counts are exact numbers of links, so a group of d *different* texts costs
d*d/block_rows**2 units; copies cost nothing.

Defined results: a null text is empty; empty texts form one class (their set is
empty) and link to no other text; a class is named by its smallest id; rows that
repeat id and text count as copies; null ids are allowed (a class of null ids has
a null name); an empty table gives an empty table; other columns are never read.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelfold.llm.common import text_of, through_table
from labelfold.llm.components import components
from labelfold.llm.exact_dedup import id_key

N, THRESHOLD, RECALL = 5, Fraction(4, 5), 0.9995


def choose_bands(threshold: float = float(THRESHOLD), recall: float = RECALL, rows: int = 5) -> tuple[int, int]:
    """(bands, rows a band): the fewest bands with 1 - (1 - t^rows)^bands >= recall at the threshold."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)), rows


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _constants(k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**63, size=k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_set(text: str, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of n words."""
    words = text.encode().split()  # bytes split on the space and U+0009 to U+000D only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size, mul = min(n, len(h)), _constants(n, 1)
    last = len(h) - size + 1
    total = np.full(last, np.uint64(size))
    for k in range(size):
        total = total + h[k:k + last] * mul[k]
    return np.unique(_mix(total))


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """MinHash signatures folded into one hash a band: (sets, bands); sets must not be empty."""
    flat, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    mul, add, fold = _constants(bands * rows, 2), _constants(bands * rows, 3), _constants(rows + 1, 4)
    out = np.zeros((len(sets), bands), dtype=np.uint64)
    for b in range(bands):
        total = np.full(len(sets), b + 1, dtype=np.uint64) * fold[rows]
        for r in range(rows):
            k = b * rows + r
            total = total + np.minimum.reduceat(flat * mul[k] + add[k], starts) * fold[r]
        out[:, b] = _mix(total)
    return out


def _sign(n: int, bands: int, rows: int, id_col: str):
    def run(batches):
        for df in batches:
            texts, begin = df["text"].tolist(), 0
            while begin < len(texts):  # about 200,000 n-grams at a time
                sets, total, end = [], 0, begin
                while end < len(texts) and total < 200_000:
                    sets.append(gram_set(texts[end], n))
                    total += len(sets[-1])
                    end += 1
                full = [s for s in sets if len(s)]
                signed = iter(band_hashes(full, bands, rows).view(np.int64) if full else ())
                part = df.iloc[begin:end]
                yield pd.DataFrame({
                    id_col: part[id_col], "h": part["h"], "key": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                    "n": [len(s) for s in sets], "bands": [next(signed).tolist() if len(s) else [] for s in sets]})
                begin = end
    return run


def _make_sets(n: int):
    def run(batches):
        for df in batches:
            yield pd.DataFrame({"key": df["key"], "bands": df["bands"], "copies": df["copies"],
                                "grams": [gram_set(x, n).tobytes() for x in df["text"]]})
    return run


def shared_grams(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets share."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.r_[True, flat[1:] != flat[:-1]]
    column = np.cumsum(first) - 1
    held = np.bincount(column)
    owner, column = owner[held[column] > 1], column[held[column] > 1]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    if len(column):
        column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1
        width = max(256, (1 << 23) // len(sets))
        for at in range(0, int(column[-1]) + 1, width):
            lo, hi = np.searchsorted(column, (at, at + width))
            m = np.zeros((len(sets), width), dtype=np.float32)
            m[owner[lo:hi], column[lo:hi] - at] = 1
            out += m @ m.T
    return out.astype(np.int64)


def links_of_unit(band: int, lo: int, hi: int, blocks, sets, bands, copies, threshold: Fraction):
    """(member, links to texts, links to documents, root member) of a unit's linked members."""
    sizes = np.array([len(s) for s in sets])
    shared = shared_grams(sets)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared * threshold.denominator >= threshold.numerator * union
    np.fill_diagonal(linked, False)
    if lo != hi:
        linked &= blocks[:, None] != blocks[None, :]
    for e in range(band):  # pairs that met in an earlier band were counted there
        linked &= bands[:, e][:, None] != bands[:, e][None, :]
    root = np.arange(len(sets))
    while True:  # smallest member reached
        near = np.where(linked, root[None, :], len(sets)).min(1)
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            break
        root = new
    texts, docs = linked.sum(1), linked @ copies
    return [(i, int(texts[i]), int(docs[i]), int(root[i])) for i in np.flatnonzero(texts)]


def _units(threshold: Fraction):
    columns = ["a", "b", "texts", "docs"]

    def done(rows):
        keys = [r.key for r in rows]
        sets = [np.frombuffer(r.grams, dtype=np.uint64) for r in rows]
        got = links_of_unit(rows[0].band, rows[0].lo, rows[0].hi, np.array([r.blk for r in rows]), sets,
                            np.array([np.asarray(r.bands) for r in rows]), np.array([r.copies for r in rows]),
                            threshold)
        return [(keys[i], keys[root], t, d) for i, t, d, root in got]

    def run(batches):
        held, unit = [], None
        for df in batches:
            out = []
            for r in df.itertuples(index=False):
                at = (r.bucket, r.lo, r.hi)
                if at != unit:
                    if len(held) > 1:
                        out += done(held)
                    held, unit = [], at
                held.append(r)
            yield pd.DataFrame(out, columns=columns)
        if len(held) > 1:
            yield pd.DataFrame(done(held), columns=columns)
    return run


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """(id, h, key, n, bands) of every row; h is the 128-bit hash of the text."""
    d = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("h", F.unhex(F.md5("text")))
    kind = d.schema["id"].dataType.simpleString()
    return d.select("id", "text", "h").mapInPandas(
        _sign(n, bands, rows, "id"), f"id {kind}, h binary, key binary, n long, bands array<long>")


def link_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                 threshold: Fraction = THRESHOLD, recall: float = RECALL, block_rows: int = 512,
                 block_grams: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """(rows, sets): ``rows`` has id, h and key of every row; ``sets`` has, for every
    different set, key, copies, texts (links to other sets), docs (links to their
    rows), and class_id and class_h, the smallest (id, h) of its class."""
    bands, band_rows = choose_bands(float(threshold), recall)
    sig = through_table(signatures(docs, id_col, text_col, n, bands, band_rows), "join-signatures")
    members = through_table(
        sig.groupBy("key").agg(F.min(F.struct("id", "h")).alias("own"), F.count(F.lit(1)).alias("copies"),
                               F.first("n").alias("n"), F.first("bands").alias("bands")), "join-members")

    entries = (members.select("key", "n", F.posexplode("bands").alias("band", "bh"))
               .select("key", "n", "band", F.xxhash64("band", "bh").alias("bucket")))
    full = (entries.groupBy("bucket", "band").agg(
        F.count(F.lit(1)).alias("m"), F.sum("n").alias("grams"), F.bit_xor(F.xxhash64("key")).alias("x"),
        F.bit_xor(F.xxhash64("key", F.lit(7))).alias("y")).filter("m > 1"))
    kept = (full.groupBy("m", "x", "y").agg(F.min(F.struct("band", "bucket", "grams")).alias("b"))
            .select("b.band", "b.bucket", F.greatest(F.ceil(F.col("m") / block_rows),
                                                     F.ceil(F.col("b.grams") / block_grams)).alias("blocks")))
    met = through_table(entries.join(kept, ["bucket", "band"]).select("key", "bucket", "band", "blocks"), "join-met")

    wanted = (met.select("key").distinct().join(members, "key")
              .select("key", F.col("own.id").alias("wid"), F.col("own.h").alias("wh"), "copies", "bands"))
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    sets = (texts.join(wanted, F.col("id").eqNullSafe(F.col("wid")) & (F.unhex(F.md5("text")) == F.col("wh")))
            .select("key", "bands", "copies", "text")
            .mapInPandas(_make_sets(n), "key binary, bands array<long>, copies long, grams binary")
            .dropDuplicates(["key"]))
    units = (met.withColumn("blk", F.pmod(F.xxhash64("key", "bucket"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("key", "bucket", "band", "blk", F.least("blk", "other").alias("lo"),
                     F.greatest("blk", "other").alias("hi"))
             .join(sets, "key").repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi"))
    found = through_table(units.mapInPandas(_units(threshold), "a binary, b binary, texts long, docs long"),
                          "join-links")

    counts = found.groupBy(F.col("a").alias("key")).agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    stars = components(found.select("a", "b")).withColumnRenamed("node", "key")
    tied = stars.join(members.select("key", "own"), "key")
    names = through_table(tied.groupBy("root").agg(F.min("own").alias("first")), "join-names")
    tied = tied.select("key", "root").join(names, "root").join(counts, "key").select("key", "first", "texts", "docs")
    out = (members.select("key", "copies", "own").join(tied, "key", "left")
           .withColumn("first", F.coalesce("first", "own"))
           .select("key", "copies", F.coalesce("texts", F.lit(0)).alias("texts"),
                   F.coalesce("docs", F.lit(0)).alias("docs"), F.col("first.id").alias("class_id"),
                   F.col("first.h").alias("class_h")))
    # written, so that a later join meets it by a plain exchange, which can be split at a hot key
    return sig.select("id", "h", "key"), through_table(out, "join-classes")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, class_id, n_links (other documents it is linked to,
    copies included) and n_text_links (different texts among them)."""
    rows, sets = link_classes(docs, id_col, text_col, **options)
    return (rows.select("id", "key").join(sets, "key")
            .select(F.col("id").alias(id_col), "class_id",
                    (F.col("copies") - 1 + F.col("docs")).alias("n_links"), F.col("texts").alias("n_text_links")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class (the smallest id), with all its columns."""
    _, sets = link_classes(docs, id_col, text_col, **options)
    key = ["h", "idv", "idnull"]
    first = sets.select(F.col("class_h").alias("h"), *id_key(F.col("class_id"))).distinct()
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)],
                      F.unhex(F.md5(text_of(text_col))).alias("h"), *id_key(F.col(id_col)))
    return own.join(first, key, "left_semi").dropDuplicates(key).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


# n-grams as texts; pairs that share any; links; classes by walking the links
NGRAM_JOIN_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, md5(coalesce(text, '')) AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS grams,
         doc_id, h FROM w),
k AS (SELECT md5(array_to_string(grams, chr(10))) AS key, any_value(grams) AS grams, count(*) AS copies,
             min(doc_id) AS first FROM s GROUP BY 1),
g AS (SELECT key, len(grams) AS n, unnest(grams) AS gram FROM k),
p AS (SELECT a.key AS a, b.key AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
      FROM g a JOIN g b ON a.gram = b.gram AND a.key <> b.key GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE shared * 5 >= 4 * (na + nb - shared)),
walk(key, reached) AS (
  SELECT key, key FROM k UNION SELECT walk.key, l.b FROM walk JOIN l ON walk.reached = l.a),
c AS (SELECT walk.key, min(k.first) AS class_id FROM walk JOIN k ON walk.reached = k.key GROUP BY 1),
n AS (SELECT l.a AS key, count(*) AS texts, sum(k.copies) AS docs FROM l JOIN k ON l.b = k.key GROUP BY 1)
SELECT s.doc_id, c.class_id, CAST(k.copies - 1 + coalesce(n.docs, 0) AS BIGINT) AS n_links,
       coalesce(n.texts, 0) AS n_text_links
FROM s JOIN k ON md5(array_to_string(s.grams, chr(10))) = k.key JOIN c ON c.key = k.key LEFT JOIN n ON n.key = k.key
"""

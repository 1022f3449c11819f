"""Operator 11: nearest neighbours by largest inner product, with collision-counting hashing.

Inner products become distances by one more coordinate: a vector x of norm |x| gets
sqrt(M^2 - |x|^2), M the largest norm, and a query is scaled to norm M and gets 0; the
squared distance is then 2 M^2 - 2 M (q . x) / |q|.  Each of ``PROJECTIONS`` random
directions gives one number per vector, and an index block keeps, per direction, its
vectors sorted by that number.

A query opens a window around its own number in every sorted array.  A vector inside
the window collides there; with ``COLLISIONS`` of the directions colliding its inner
product is computed.  Windows grow by ``GROWTH`` (virtual rehashing: a wider window is
read from the same arrays, and only its new ends are counted) until the k-th verified
distance is one that the window finds with probability ``FIND``, or they hold the whole
block.  The directions are orthonormal, so counts scatter less than the binomial that
the bound uses: recall lies above ``FIND``.

Index: vectors get one of 65 536 cells, the interleaved bits of their first four numbers.
Cells in order are cut into blocks by their running count, and a cell too large for one
block is dealt into several by the id's hash, so blocks hold neighbouring vectors and
their number follows the rows alone.  Every block of at most ``BLOCK`` rows is one row of
the written index table.  First every query searches its own block;
its k-th distance there bounds the search of the others.  A block is skipped, without
loss, when too few of its arrays reach into the query's final windows for anything in
it to collide often enough.  The task of a block streams the written queries past it;
nothing is broadcast or collected, and a block gives at most k rows per query.  The
query set grows with the table, so the pairs of blocks do as their product; on
directionless data, where no block can be skipped, the work grows so too.

Scores of what is returned are summed in component order in double precision.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component, and rows with a null id, take no part; vectors of different lengths count as
padded with zeros; rows that repeat an id are rows each, and a query skips its own row
only; equal scores go by ascending id; with fewer than k candidates all are given; an
empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from math import comb
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelfold.llm.common import through_table
from labelfold.llm.shards import record_batches

TOP, QUERY_STEP = 20, 20
PROJECTIONS, COLLISIONS = 64, 48
#: Growth of the windows from one level to the next, and the probability of finding a vector within the bound.
GROWTH, FIND = 1.2, 0.8
#: Rows of an index block, about 1.3 KB each at 64 components; places in it are 16-bit numbers.
BLOCK = 16_384
#: Windows that hold more than this share of a block are counted by comparing ranks, not by walking them.
WIDE = 0.03
SEED = 11


def directions(d: int, m: int = PROJECTIONS):
    """m x d directions: rows of random orthonormal bases; plain Gaussian where d is too small for those."""
    import numpy as np

    rng = np.random.default_rng(SEED)
    if d < 16:
        return rng.normal(size=(m, d)) / np.sqrt(d)
    found = [np.linalg.qr(rng.normal(size=(d, min(d, m - at))))[0].T for at in range(0, m, d)]
    return np.concatenate(found)


def window_ratio(m: int = PROJECTIONS, least: int = COLLISIONS, find: float = FIND) -> float:
    """Half width of a window, in deviations of the distance's projection, that finds a vector
    with the given probability: ``least`` of m independent directions collide."""
    lo, hi = 0.0, 1.0
    for _ in range(60):
        p = (lo + hi) / 2
        reached = sum(comb(m, i) * p**i * (1 - p)**(m - i) for i in range(least, m + 1))
        lo, hi = (p, hi) if reached < find else (lo, p)
    return NormalDist().inv_cdf((1 + min(hi, 1 - 1e-12)) / 2)


def exact_scores(a, b):
    """Inner products of paired rows, summed in component order."""
    import numpy as np

    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


class Block:
    """One index block: vectors, and per direction their numbers in order."""

    def __init__(self, ids, vectors, top_norm: float, order=None, values=None):
        import numpy as np

        self.ids, self.vectors, self.top = ids, vectors, top_norm
        n, d = vectors.shape
        self.axes = directions(d + 1)
        if order is None:
            numbers = self.numbers(vectors, np.sqrt(np.maximum(top_norm**2 - (vectors**2).sum(axis=1), 0)))
            order = np.argsort(numbers, axis=0, kind="stable").T.astype(np.int16)
            values = np.ascontiguousarray(np.take_along_axis(numbers.T, order.astype(np.int64), axis=1))
        self.order, self.values = order, values
        self.ranks = np.empty(order.shape, np.int16)  # of every vector in every sorted array
        np.put_along_axis(self.ranks, order.astype(np.int64), np.arange(n, dtype=np.int16)[None, :], axis=1)

    def numbers(self, vectors, last):
        """Projections of vectors with their further coordinate."""
        return vectors @ self.axes[:, :-1].T + last[:, None] * self.axes[:, -1]

    def search(self, queries, k: int, bounds=None, own=None):
        """(query, row, score) arrays: the best k rows of each query, and the number of verified pairs.

        ``bounds``: squared distances beyond which nothing is wanted; ``own``: a row to leave out."""
        import numpy as np

        n, m = len(self.ids), len(self.axes)
        norms = np.sqrt((queries**2).sum(axis=1))
        at = self.numbers(queries * (self.top / norms)[:, None], np.zeros(len(queries)))
        ratio, unit = window_ratio(), 1 / np.sqrt(self.axes.shape[1])
        widest = max(float((self.values[:, -1].max() - at.min())), float(at.max() - self.values[:, 0].min()), 1e-300)
        floor = max(0.25 * self.top * unit, widest * 1e-9)
        halves = [floor * GROWTH**i for i in range(200) if floor * GROWTH**(i - 1) < widest]
        reach = [(h / (ratio * unit))**2 for h in halves]  # squared distance found at each level
        last = np.full(len(queries), len(halves) - 1)
        if bounds is not None:
            last = np.minimum(np.searchsorted(reach, bounds), last)
            half = np.array(halves)[last][:, None]
            near = ((at - half <= self.values[:, -1]) & (at + half >= self.values[:, 0])).sum(axis=1) >= COLLISIONS
        else:
            near = np.ones(len(queries), bool)
        todo = np.flatnonzero(near)
        lows = np.empty((len(halves), m, len(todo)), np.int64)
        highs = np.empty_like(lows)
        for j in range(m):
            for i, h in enumerate(halves):
                lows[i, j] = np.searchsorted(self.values[j], at[todo, j] - h, "left")
                highs[i, j] = np.searchsorted(self.values[j], at[todo, j] + h, "right")
        found, verified = [], 0
        for x, q in enumerate(todo):
            # a bound from elsewhere is likely near the end, so windows start one level before it
            first = 0 if bounds is None or last[q] == len(halves) - 1 else max(last[q] - 1, 0)
            rows, scores = self._one(queries[q], norms[q], lows[:, :, x], highs[:, :, x], reach, range(first, last[q] + 1), k,
                                     None if own is None else own[q])
            verified += len(rows)
            if len(rows) > k:  # what rounding could put among the best stays until scores are exact
                kth = np.partition(scores, -k)[-k]
                rows = rows[scores >= kth - 1e-9 * self.top * norms[q]]
            found.append((np.full(len(rows), q), rows))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), 0
        q, rows = (np.concatenate(c) for c in zip(*found))
        scores = exact_scores(queries[q], self.vectors[rows])
        order = np.lexsort((self.ids[rows], -scores, q))
        q, rows, scores = q[order], rows[order], scores[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        return q[place < k], rows[place < k], scores[place < k], verified

    def _one(self, query, norm, lows, highs, reach, levels, k, own):
        """Rows verified for one query and their products."""
        import numpy as np

        n, counts, before = len(self.ids), None, None
        seen = np.zeros(n, bool)
        if own is not None:
            seen[own] = True
        rows, scores = [], np.empty(0)
        for i in levels:
            counts = self._count(lows[i], highs[i], counts, before)
            before = lows[i], highs[i]
            hit = np.flatnonzero((counts >= COLLISIONS) & ~seen)
            if len(hit):
                seen[hit] = True
                rows.append(hit)
                scores = np.append(scores, self.vectors[hit] @ query)
            if len(scores) >= k:
                kth = np.partition(scores, -k)[-k]
                if 2 * self.top**2 - 2 * self.top * kth / norm <= reach[i]:
                    break
        return (np.concatenate(rows) if rows else np.empty(0, np.int64)), scores

    def _count(self, lo, hi, counts, before):
        """Collisions of every row in the windows [lo, hi) of the sorted arrays, from those of narrower windows."""
        import numpy as np

        ends = [(lo, hi)] if before is None else [(lo, before[0]), (before[1], hi)]
        if sum(int((b - a).sum()) for a, b in ends) > WIDE * self.order.size:
            a, b = lo.astype(np.int16)[:, None], (hi - 1).astype(np.int16)[:, None]
            return ((self.ranks >= a) & (self.ranks <= b)).sum(axis=0, dtype=np.uint8)
        new = np.concatenate([o[x:y] for a, b in ends for o, x, y in zip(self.order, a, b)])
        more = np.bincount(new, minlength=len(self.ids)).astype(np.uint8)
        return more if counts is None else counts + more


def _components(col: Column) -> Column:
    return col.cast("array<double>")


def _valid(v: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _with_cells(d: int, top: float):
    """(id, v) batches -> (id, v padded, cell): four bits of each of the first four numbers, interleaved."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        axes = directions(d + 1)[:4]
        for batch in batches:
            flat, sizes = batch.column(1).flatten().to_numpy(), np.diff(batch.column(1).offsets.to_numpy())
            v = np.zeros((batch.num_rows, d))
            v[np.arange(d) < sizes[:, None]] = flat
            last = np.sqrt(np.maximum(top**2 - (v**2).sum(axis=1), 0))
            spread = (v @ axes[:, :-1].T + last[:, None] * axes[:, -1]) * np.sqrt(d + 1) / top
            level = np.clip(np.floor(spread * 4) + 8, 0, 15).astype(np.int64)
            cell = sum(((level[:, j] >> b) & 1) << (4 * b + j) for j in range(level.shape[1]) for b in range(4))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * d, pa.int32()), v.ravel()),
                 pa.array(cell, pa.int64())], names=["id", "v", "cell"])
    return run


BLOCK_SCHEMA = "block string, ids binary, vectors binary, sorted binary, numbers binary"


def block_names(placed: DataFrame, rows: int) -> DataFrame:
    """(id, v, block) with blocks of about rows / 2 vectors; the counted cells are 65 536 rows at most."""
    half = max(rows // 2, 1)
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    cells = (cells.withColumn("start", F.sum("n").over(Window.orderBy("cell")) - F.col("n"))
             .withColumn("parts", F.ceil(F.col("n") / half)))
    name = F.when(F.col("parts") == 1, F.concat(F.lit("r"), F.floor(F.col("start") / half))).otherwise(
        F.concat_ws("-", F.lit("c"), "cell", F.pmod(F.xxhash64("id"), F.col("parts"))))
    return placed.join(F.broadcast(cells), "cell").select("id", "v", name.alias("block"))


def _build_blocks(d: int, top: float, rows: int):
    """Vectors sorted by block -> index rows of at most ``rows`` vectors."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def row(name, made, held):
            b = Block(np.concatenate([p[0] for p in held]), np.concatenate([p[1] for p in held]), top)
            cells = [b.ids.tobytes(), b.vectors.tobytes(), b.order.tobytes(), b.values.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([f"{name}-{made}"]), *[pa.array([c], pa.binary()) for c in cells]],
                                              names=["block", "ids", "vectors", "sorted", "numbers"])

        name, made, held, n = None, 0, [], 0
        for batch in batches:
            names = batch.column(2).to_numpy(zero_copy_only=False)
            ids, vectors = batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy().reshape(-1, d)
            cuts = np.flatnonzero(names[1:] != names[:-1]) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(names)]):
                if hi > lo and names[lo] != name:
                    if n:
                        yield row(name, made, held)
                    name, made, held, n = names[lo], 0, [], 0
                while lo < hi:
                    end = min(hi, lo + rows - n)
                    held.append((ids[lo:end], vectors[lo:end]))
                    n, lo = n + end - lo, end
                    if n == rows:
                        yield row(name, made, held)
                        made, held, n = made + 1, [], 0
        if n:
            yield row(name, made, held)
    return run


def _blocks(batches, d: int, top: float):
    """(name, Block) of every index row."""
    import numpy as np

    for batch in batches:
        for i in range(batch.num_rows):
            name, ids, vectors, order, numbers = (batch.column(c)[i].as_py() for c in range(5))
            ids = np.frombuffer(ids, np.int64)
            yield name, Block(ids, np.frombuffer(vectors).reshape(-1, d), top, np.frombuffer(order, np.int16).reshape(-1, len(ids)),
                              np.frombuffer(numbers).reshape(-1, len(ids)))


QUERY_SCHEMA = "home string, row int, query_id long, v binary, bound double, near array<long>, near_scores array<double>"


def _search_home(d: int, top: float, step: int, k: int):
    """Index rows -> the queries among their vectors with what their own block holds."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for name, block in _blocks(batches, d, top):
            own = np.flatnonzero(block.ids % step == 0)
            if not len(own):
                continue
            v = block.vectors[own]
            q, rows, scores, _ = block.search(v, k, own=own)
            starts = np.searchsorted(q, np.arange(len(own) + 1))
            full = np.diff(starts) == k
            bound = np.full(len(own), np.inf)
            norms = np.sqrt((v**2).sum(axis=1))
            bound[full] = (2 * top**2 - 2 * top * scores[starts[1:][full] - 1] / norms[full]) * (1 + 1e-9) + 1e-12 * top**2
            ends = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(own)), pa.array(own, pa.int32()), pa.array(block.ids[own]),
                 pa.array([x.tobytes() for x in v], pa.binary()), pa.array(bound),
                 pa.ListArray.from_arrays(ends, block.ids[rows]), pa.ListArray.from_arrays(ends, scores)],
                names=["home", "row", "query_id", "v", "bound", "near", "near_scores"])
    return run


FOUND_SCHEMA = "home string, row int, query_id long, vec_id long, score double"


def _search_others(d: int, top: float, k: int, queries: str):
    """Index rows -> the best k of each for the queries of other blocks, within their bounds."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for name, block in _blocks(batches, d, top):
            for part in record_batches(queries, ["home", "row", "query_id", "v", "bound"], 1024):
                keep = np.flatnonzero(part.column(0).to_numpy(zero_copy_only=False) != name)
                if not len(keep):
                    continue
                part = part.take(pa.array(keep))
                v = np.frombuffer(b"".join(part.column(3).to_pylist())).reshape(-1, d)
                q, rows, scores, _ = block.search(v, k, part.column(4).to_numpy())
                if len(q):
                    at = part.take(pa.array(q))
                    yield pa.RecordBatch.from_arrays(
                        [at.column(0), at.column(1), at.column(2), pa.array(block.ids[rows]), pa.array(scores)],
                        names=["home", "row", "query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = TOP,
            query_step: int = QUERY_STEP, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found of every row whose id ``query_step`` divides."""
    if not 1 <= block <= 32_767:
        raise ValueError(f"a block holds 1 to 32767 rows, not {block}")
    spark = vectors.sparkSession
    own = (vectors.select(F.col(id_col).cast("long").alias("id"), _components(F.col(vector_col)).alias("v"))
           .filter(F.col("id").isNotNull() & _valid(F.col("v"))))
    facts = own.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"),
                    F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("top")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, top = facts["d"], facts["top"] ** 0.5
    placed = through_table(own.mapInArrow(_with_cells(d, top), "id long, v array<double>, cell long"), "vectors")
    index = through_table(
        block_names(placed, block).repartition(1 + 2 * facts["n"] // block, "block").sortWithinPartitions("block")
        .mapInArrow(_build_blocks(d, top, block), BLOCK_SCHEMA), "ann-index")
    queries = through_table(index.mapInArrow(_search_home(d, top, query_step, k), QUERY_SCHEMA), "ann-queries")
    near = queries.select("home", "row", "query_id", F.inline(F.arrays_zip("near", "near_scores")).alias("vec_id", "score"))
    where = queries.inputFiles()
    if where:
        near = near.unionByName(index.mapInArrow(_search_others(d, top, k, where[0].rsplit("/", 1)[0]), FOUND_SCHEMA))
    order = Window.partitionBy("home", "row").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

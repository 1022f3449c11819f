"""Exact ROC AUC per label without a hot partition.

AUC_k = sum over positive cells of  P(neg score < p) + 1/2 P(neg score = p).

A window ``partitionBy(label).orderBy(score)`` over the rows would put a whole
label (a tenth of all cells, or far more with few labels) into one task, and any
fixed score bucket does the same when scores cluster (a confident model puts
most negatives below 0.001).  Instead, in two levels and inside the JVM:

1. ``groupBy(label, score)`` counts positives and negatives, combined in the scan
   tasks, so a repeated score is one row per task whatever share of the rows it
   holds.  The counts are written once into the shared folder: the input is read
   once, and nothing later grows with anything but the distinct scores.
2. Scores of a label are cut into buckets of about ``BUCKET_ROWS`` distinct scores
   at quantiles of a mergeable sketch over the counts (at most ``MAX_BUCKETS`` a
   label, so the cut table stays small).  A score finds its bucket by binary search.
3. A window per (label, bucket) gives each score the negatives below it in its
   bucket; each bucket becomes one row: positives, negatives, those above the
   threshold, and sum(pos * (2 * neg_below_in_bucket + neg)).
4. Over those few rows a window adds the negatives of the earlier buckets, and
   sum(pos * (offset + below)) = offset * pos_bucket + sum(pos * below), so no row is
   ever joined back.

The same table holds the confusion counts at a threshold and, under label -1,
the exact-match count, so reports that need both read the data once.

Counts are int64; the weighted sums are DECIMAL(38,0), so the result equals the
single-window rank-sum form even when one score holds a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sqltext as X
from ..functions.labels import per_label
from ..session import scratch_path
from .frame import EvalFrame

EXACT = -1  # the label under which rows are counted as exact matches (pos) or not (neg)
#: Distinct scores of a bucket, and buckets of a label at most (beyond them buckets grow and spill).
BUCKET_ROWS, MAX_BUCKETS = 250_000, 4096


def label_sums(ef: EvalFrame, t=0.5, op: str = "gt", partitions: int | None = None,
               exact: bool = False) -> DataFrame:
    """(label_idx, n_pos, n_neg, tp, fp, s2), s2 = 2 * sum(pos * (neg_below + neg/2)).

    With ``exact``, label -1 counts rows whose predicted and true vectors agree
    (n_pos) or not (n_neg).  ``partitions`` is the number of buckets of a label (default:
    by the distinct scores)."""
    ef.require_truth()
    if op not in ("gt", "ge"):
        raise ValueError(f"op must be 'gt' or 'ge', not {op!r}")
    ts = per_label(t, ef.k)
    cells = truth_cells(ef)
    if exact:
        cells.append(exact_cell(ef, ts, op))
    return sums_of_cells(ef.df.select(X.inline_rows(cells)), ts, op, partitions)


def exact_cell(ef: EvalFrame, ts: list, op: str) -> str:
    """SQL text of a row's struct under label ``EXACT``."""
    same = X.all_of([f"{X.as_int(X.above(X.elem('score', i), ts[i], op))} = {X.elem('y_true', i)}" for i in range(ef.k)])
    return X.named_struct([("label_idx", X.lit(EXACT)), ("p", "0.0D"), ("pos", f"CAST({same} AS BIGINT)"),
                           ("neg", f"CAST(NOT {same} AS BIGINT)")])


def truth_cells(ef: EvalFrame) -> list[str]:
    """SQL text of a row's (label_idx, p, pos, neg) structs, one per label."""
    y = [X.elem("y_true", i) for i in range(ef.k)]
    return [X.named_struct([("label_idx", X.lit(i)), ("p", X.score_or_lowest(X.elem("score", i))),
                            ("pos", f"CAST({y[i]} AS BIGINT)"), ("neg", f"CAST(1 - {y[i]} AS BIGINT)")])
            for i in range(ef.k)]


def written_counts(cells: DataFrame) -> DataFrame:
    """(label_idx, p, pos, neg), one row per label and distinct score, from the shared folder."""
    spark = cells.sparkSession
    path = scratch_path(spark, "score-counts")
    cells.groupBy("label_idx", "p").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).write.parquet(path)
    return spark.read.schema("label_idx int, p double, pos long, neg long").parquet(path)


def with_buckets(counts: DataFrame, buckets: int | None = None) -> DataFrame:
    """The counts with the bucket of every score: the number of its label's cuts below it."""
    if buckets is None:
        buckets = min(MAX_BUCKETS, 1 + counts.count() // BUCKET_ROWS)
    if buckets <= 1:
        return counts.withColumn("bucket", F.lit(0))
    steps = [1 << b for b in reversed(range((buckets - 1).bit_length()))]
    wanted = ", ".join(X.lit(i / buckets) for i in range(1, buckets))
    # per label at most MAX_BUCKETS cuts, filled up to a power of two for the binary search
    cuts = counts.groupBy("label_idx").agg(F.expr(
        f"concat(approx_percentile(p, array({wanted}), {max(10_000, 20 * buckets)}), "
        f"array_repeat(CAST('Infinity' AS DOUBLE), {2 * steps[0] - buckets}))").alias("cuts"))
    find = (f"aggregate(array({', '.join(map(str, steps))}), 0, "
            "(at, step) -> at + CASE WHEN cuts[at + step - 1] < p THEN step ELSE 0 END)")
    return counts.join(F.broadcast(cuts), "label_idx").withColumn("bucket", F.expr(find)).drop("cuts")


def sums_of_cells(cells: DataFrame, ts: list, op: str = "gt", partitions: int | None = None) -> DataFrame:
    """``label_sums`` of (label_idx, p, pos, neg) rows, of which several may share a key."""
    return sums_of_counts(written_counts(cells), ts, op, partitions)


def sums_of_counts(counts: DataFrame, ts: list, op: str = "gt", partitions: int | None = None) -> DataFrame:
    """``label_sums`` of written counts, one row per label and distinct score."""
    limit = X.array_of([X.lit(float(t)) for t in ts])
    hit = f"(label_idx >= 0 AND p {'>' if op == 'gt' else '>='} {limit}[greatest(label_idx, 0)])"
    below = Window.partitionBy("label_idx", "bucket").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    ranked = with_buckets(counts, partitions).withColumn("below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    sums = ranked.groupBy("label_idx", "bucket").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
        F.expr(f"sum(CASE WHEN {hit} THEN pos ELSE 0 END)").alias("tp"),
        F.expr(f"sum(CASE WHEN {hit} THEN neg ELSE 0 END)").alias("fp"),
        F.expr("sum(CAST(pos AS DECIMAL(19,0)) * CAST(2 * below + neg AS DECIMAL(19,0)))").alias("s2"))
    w_off = Window.partitionBy("label_idx").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("off", F.coalesce(F.sum("neg").over(w_off), F.lit(0)))
    return sums.groupBy("label_idx").agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
        F.expr("sum(s2 + CAST(2 * off AS DECIMAL(19,0)) * CAST(pos AS DECIMAL(19,0)))").alias("s2"))


AUC_SQL = ("CASE WHEN n_pos > 0 AND n_neg > 0 THEN CAST(s2 AS DOUBLE) / "
           "(CAST(n_pos AS DOUBLE) * CAST(n_neg AS DOUBLE) * 2.0D) END")


def roc_auc(ef: EvalFrame, partitions: int | None = None) -> DataFrame:
    """(label_idx, label, auc, n_pos, n_neg); auc is null when a label has one class."""
    names = X.array_of([X.lit(n) for n in ef.names])
    return label_sums(ef, partitions=partitions).selectExpr(
        "label_idx", f"{names}[label_idx] AS label", f"{AUC_SQL} AS auc",
        "CAST(n_pos AS BIGINT) AS n_pos", "CAST(n_neg AS BIGINT) AS n_neg")

"""Most frequent values in bounded memory: mergeable summaries, an exact second pass, a proven bound.

``groupBy(value)`` spills when nearly all values differ.  Here every task keeps at most
``counters`` values with a count each.  When a batch takes it beyond that, the count of the
first value too many is taken off all counts and what is left of nothing goes, so a value's
true count exceeds what is held by at most the sum of what was ever taken off, in every task.
Held counts are added over the tasks and the best ``counters`` values become candidates; a
second pass counts only these, exactly.  Any other value occurs at most

    (the largest sum of held counts that is no candidate) + (all that was taken off)

times.  When the last of the top counts is above this bound the result is proven; when
nothing was taken off and nothing left out, the held counts are the true ones already.
Otherwise (no value stands out) all values are counted in full.

Defined results: null is a value; ties go to the larger value; an empty frame gives no rows;
fewer values than ``top`` give all of them.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Values a task holds; also the most candidates of the second pass, so its broadcast has this bound.
COUNTERS = 4096


def _summary(counters: int):
    """(kind, value, held) of a task: kind 0 a held value, 1 what was taken off, 2 the task's rows."""
    def run(batches):
        held, taken, rows = None, 0, 0
        for batch in batches:
            rows += batch.num_rows
            counted = pc.value_counts(batch.column(0))
            part = pa.table({"value": counted.field("values"), "n": counted.field("counts")})
            if held is not None:
                part = pa.concat_tables([held, part]).group_by("value").aggregate([("n", "sum")]).rename_columns(["value", "n"])
            if part.num_rows > counters:
                part = part.sort_by([("n", "descending")])
                off = part["n"][counters].as_py()
                taken += off
                part = part.slice(0, counters).set_column(1, "n", pc.subtract(part["n"].slice(0, counters), off))
                part = part.filter(pc.greater(part["n"], 0))
            held = part
        values = (held["value"] if held is not None else pa.chunked_array([[]], pa.string())).combine_chunks()
        counts = (held["n"] if held is not None else pa.chunked_array([[]], pa.int64())).combine_chunks()
        yield pa.record_batch([
            pa.array([0] * len(values) + [1, 2], pa.int32()),
            pa.concat_arrays([values.cast(pa.string()), pa.nulls(2, pa.string())]),
            pa.concat_arrays([counts.cast(pa.int64()), pa.array([taken, rows], pa.int64())])], names=["kind", "value", "held"])
    return run


def top_counts(df: DataFrame, key: str, top: int, counters: int = COUNTERS) -> tuple[DataFrame, int, str]:
    """(rows of (key, count), number of all rows, how it was found) of the ``top`` values of a string column.

    How: "held" when no task ever took anything off, "proven" by the bound after the second
    pass, "counted" when all values had to be counted."""
    if top > counters:
        raise ValueError(f"{counters} counters cannot prove the top {top}")
    spark, keys = df.sparkSession, df.select(F.col(key).cast("string").alias(key))
    path = scratch_path(spark, "frequent-values")
    keys.mapInArrow(_summary(counters), "kind int, value string, held long").write.parquet(path)
    summary = spark.read.schema("kind int, value string, held long").parquet(path)
    ends = {r.kind: r.n for r in summary.filter("kind > 0").groupBy("kind").agg(F.sum("held").alias("n")).collect()}
    taken, rows = ends.get(1, 0), ends.get(2, 0)
    order = [F.col("count").desc(), F.col(key).desc()]
    held = summary.filter("kind = 0").groupBy(F.col("value").alias(key)).agg(F.sum("held").alias("count"))
    if taken == 0:
        return held.orderBy(*order).limit(top), rows, "held"
    # one value more than the candidates: its held count bounds all that are left out
    at = scratch_path(spark, "frequent-candidates")
    held.orderBy(*order).limit(counters + 1).write.parquet(at)
    best = spark.read.schema(f"`{key}` string, count long").parquet(at).orderBy(*order)
    bound = taken + (best.agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("least"))
                     .select(F.expr(f"CASE WHEN n > {counters} THEN least ELSE 0L END").alias("left_out")).first().left_out)
    candidates = best.limit(counters).select(F.col(key).alias("_candidate"))
    exact = scratch_path(spark, "frequent-counts")
    (keys.join(F.broadcast(candidates), F.col(key).eqNullSafe(F.col("_candidate")), "left_semi")
     .groupBy(key).agg(F.count(F.lit(1)).alias("count")).orderBy(*order).limit(top).write.parquet(exact))
    found = spark.read.schema(f"`{key}` string, count long").parquet(exact)
    last = found.agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("least")).first()
    if last.n == top and last.least > bound:
        return found, rows, "proven"
    return keys.groupBy(key).agg(F.count(F.lit(1)).alias("count")).orderBy(*order).limit(top), rows, "counted"

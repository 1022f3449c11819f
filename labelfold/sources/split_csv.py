"""Quoted CSV read by many tasks a file.

A line break inside quotes makes Spark read a CSV file whole (``multiLine``), one task
per file.  Here files are read as text lines, which split anywhere, and records are put
together again from quote parity: a physical line begins a record exactly when an even
number of quotes stands before it in its file.

1. Every byte range (as Spark cuts them) counts its quotes: one row per range, summed in
   the scan.
2. A prefix scan of those parities per file, over the few range rows, says whether a
   range begins inside quotes.
3. Each range is read again, in its tasks, from its first true record start on; lines are
   joined into whole records as they stream by.  Only what crosses a border, at most an
   open record and a leading piece per range, is shuffled and joined in file order.
4. Records become columns by ``from_csv``, with the reader's own parser and options.

Nothing is collected but the number of files with an odd number of quotes: such a file is
no RFC-4180 CSV (a quote stands in an unquoted field, or a quoted one never ends), parity
means nothing in it, and it is refused; read it with ``multiLine``.

Defined results: empty lines are skipped, a last line without line break counts, ``\\r\\n``
ends a record like ``\\n``; every file's first record is its header; empty files and
folders give no rows; partition columns of the folder are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Range rows broadcast to the tasks at most (about 150 bytes each): a million ranges of 128 MB.
BROADCAST_RANGES = 1_000_000
WHOLE, PIECE, OPEN = 0, 1, 2


def _assemble(kept: int):
    """Lines (value, file, start, inside, kept columns) of ranges, in order -> rows (record, file, start,
    kind, first, kept columns): whole records, the leading piece of an earlier one, the record left open."""
    def run(batches):
        import pyarrow as pa

        at, rows, lines, kind, odd, first, own = None, [], [], WHOLE, 0, False, ()

        def emit(ends: bool):
            nonlocal lines, first
            if lines and not (ends and kind == WHOLE and lines in ([""], ["\r"])):  # an empty line is no record, nor a header
                rows.append(("\n".join(lines), *at, kind if ends or kind == PIECE else OPEN, first, *own))
                first = False
            lines = []

        def batch():
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        names = ["record", "file", "start", "kind", "first"]
        types = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_()]
        for b in batches:
            if len(names) == 5:
                names += b.schema.names[4:4 + kept]
                types += [f.type for f in b.schema][4:4 + kept]
            for value, file, start, inside, *more in zip(*(c.to_pylist() for c in b.columns)):
                if at != (file, start):
                    if at is not None:
                        emit(not odd)
                    at, own, first, odd = (file, start), tuple(more), start == 0, int(inside)
                    kind = PIECE if inside else WHOLE
                lines.append(value)
                odd ^= value.count('"') & 1
                if not odd:
                    emit(True)
                    kind = WHOLE
            if rows:
                yield batch()
        if at is not None:
            emit(not odd)
        if rows:
            yield batch()
    return run


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, first, partition columns): the records of quoted CSV files as text; ``first`` begins a file."""
    text = spark.read.option("lineSep", "\n").text(path)
    kept = [c for c in text.columns if c != "value"]
    lines = text.select("value", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("start"), *kept)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    ranges = lines.select("file", "start", quotes.alias("q")).groupBy("file", "start").agg(F.sum("q").alias("q"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = ranges.select("file", "start", F.col("q"), (F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2 == 1).alias("inside"))
    states = _written(states, "csv-ranges")
    odd = states.groupBy("file").agg((F.sum("q") % 2).alias("odd")).agg(F.sum("odd").alias("odd"), F.count(F.lit(1)).alias("n")).first()
    if odd["odd"]:
        raise ValueError(f"{odd['odd']} of {odd['n']} files under {path} hold an odd number of quotes; read them with splittable=False")
    states = states.drop("q")
    if states.count() > BROADCAST_RANGES:  # a shuffled join would lose the order of lines
        raise ValueError(f"more than {BROADCAST_RANGES} ranges under {path}; read its folders one by one")
    at = lines.join(F.broadcast(states), ["file", "start"]).select("value", "file", "start", "inside", *kept)
    schema = T.StructType([T.StructField("record", T.StringType()), T.StructField("file", T.StringType()),
                           T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()),
                           T.StructField("first", T.BooleanType()), *[text.schema[c] for c in kept]])
    parts = at.mapInArrow(_assemble(len(kept)), schema)
    whole = parts.filter(F.col("kind") == WHOLE).select("record", "first", *kept)
    # an open record is followed by pieces until the next one opens
    order = Window.partitionBy("file").orderBy("start", "kind")
    crossing = (parts.filter(F.col("kind") != WHOLE)
                .withColumn("g", F.sum(F.when(F.col("kind") == OPEN, 1).otherwise(0)).over(order))
                .groupBy("file", "g", *kept).agg(F.sort_array(F.collect_list(F.struct("start", "kind", "record"))).alias("p"),
                                                 F.max("first").alias("first"))
                .select(F.array_join("p.record", "\n").alias("record"), "first", *kept))
    return whole.unionByName(crossing)


def _written(df: DataFrame, name: str) -> DataFrame:
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Quoted CSV files with the given columns (and the folder's partition columns)."""
    records = csv_records(spark, path)
    kept = [c for c in records.columns if c not in ("record", "first")]
    if header:
        records = records.filter(~F.col("first"))
    record = F.regexp_replace("record", r"\r$", "")
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    return (records.select(record.alias("record"), *kept).filter("record <> ''")
            .select(F.from_csv("record", _ddl(schema), options).alias("r"), *kept)
            .select("r.*", *kept))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)

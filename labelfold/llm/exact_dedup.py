"""Operator 6: exact deduplication by 128-bit content hash with a byte comparison.

Rows are grouped by the 128-bit MD5 of the normalised text *and* the text
itself, so two texts that share a hash but differ in any byte stay apart; the
smallest id of a group is kept.  The grouping combines on the map side: a group
that holds a third of all rows leaves each scan task as one row.  Only ids and
hashes are shuffled for the second step, which gives every row its group; both
sides of that join are plain exchanges, so adaptive execution can split a hot
hash.

Defined results: a null text is the empty text; a null id sorts after every
other id (a group of null ids keeps null); rows that repeat both id and text
are one document, so all of them count in ``group_size`` and are marked kept
(:func:`keep_first` returns only one of them); an empty table gives an empty
table; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelfold.llm.common import SPACE, text_of


def normalised(text_col: str) -> Column:
    """The text with every run of white space replaced by one space."""
    return F.regexp_replace(text_of(text_col), SPACE, " ")


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per different text: hashes, smallest id, number of rows."""
    norm = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"))
    return (norm.groupBy(F.unhex(F.md5("norm")).alias("h"), "norm")
            .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .select("h", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    rows = (docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"))
            .select("id", F.unhex(F.md5("norm")).alias("h"), F.unhex(F.sha2("norm", 256)).alias("sha")))
    return (rows.join(_classes(docs, id_col, text_col), ["h", "sha"])
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def id_key(col: Column) -> list[Column]:
    """An id as two columns without nulls, so that joining and dropping repeats on them share one exchange."""
    return [F.coalesce(col.cast("string"), F.lit("")).alias("idv"), col.isNull().alias("idnull")]


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    The kept id is part of the join key, so the rows of a hot group spread
    over all tasks; rows that repeat id and text collapse on the same keys
    without a further exchange.
    """
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    norm = normalised(text_col)
    key = ["h", "sha", "idv", "idnull"]
    rows = docs.select(*own, F.unhex(F.md5(norm)).alias("h"), F.unhex(F.sha2(norm, 256)).alias("sha"),
                       *id_key(F.col(id_col)))
    keep = _classes(docs, id_col, text_col).select("h", "sha", *id_key(F.col("keep_id")))
    return rows.join(keep, key, "left_semi").dropDuplicates(key).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


EXACT_DEDUP_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""

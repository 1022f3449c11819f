"""The evaluation frame every evaluation operator consumes.

    keys...  row key columns (unique per row)
    y_true   array<int>     one 0/1 entry per label
    score    array<double>  one score per label
    text     string         optional

K comes from the label dictionary, so per-label expressions are generated at
plan time (K element accesses) and stay inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sqltext as X
from ..functions.dictionary import LabelDictionary
from ..functions.labels import per_label


@dataclass(frozen=True)
class EvalFrame:
    df: DataFrame
    keys: tuple
    labels: LabelDictionary
    has_truth: bool = True

    @property
    def k(self) -> int:
        return self.labels.k

    @property
    def names(self) -> list:
        return list(self.labels.names)

    def with_df(self, df: DataFrame) -> "EvalFrame":
        return replace(self, df=df)

    def cache(self) -> "EvalFrame":
        return self.with_df(self.df.cache())

    def require_truth(self) -> None:
        if not self.has_truth:
            raise ValueError("this frame has no label columns: metrics need y_true "
                             "(predictions are still available through scoring)")


def from_wide(df: DataFrame, keys, labels: LabelDictionary, truth_cols=None,
              score_cols=None, text_col: str | None = None) -> EvalFrame:
    """Build an evaluation frame from one column per label."""
    cols = [F.col(c) for c in keys]
    if text_col:
        cols.append(F.col(text_col).cast("string").alias("text"))
    has_truth = truth_cols is not None
    if has_truth:
        cols.append(F.array(*[F.col(c).cast("int") for c in truth_cols]).alias("y_true"))
    if score_cols is not None:
        cols.append(F.array(*[F.col(c).cast("double") for c in score_cols]).alias("score"))
    return EvalFrame(df.select(*cols), tuple(keys), labels, has_truth)

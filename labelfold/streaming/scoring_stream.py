"""G1: validate and score requests as they arrive.

The stream uses exactly the batch expressions (validation, linear head,
sigmoid, labels/top): scoring is stateless, so a micro-batch is just a
batch.  ``foreachBatch`` sends accepted and rejected rows to two sinks; each
micro-batch writes its own ``batch=<id>`` folder with overwrite, so a replay
after a failure rewrites the same folder instead of duplicating rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.corpus import DEFAULT_THRESHOLD, THRESHOLD_RANGE, validate_requests


def threshold_reason(threshold) -> F.Column:
    lo, hi = THRESHOLD_RANGE
    return F.when((threshold < lo) | (threshold > hi), F.lit("threshold_out_of_range"))


def prepare_requests(df: DataFrame, threshold_col: str = "threshold", text_col: str = "text") -> DataFrame:
    """``reason`` of every request, null when accepted: text and threshold where
    requests carry texts, the threshold alone where they carry vectors."""
    if text_col in df.columns:
        return validate_requests(df, text_col, threshold_col)
    t = F.coalesce(F.col(threshold_col).cast("double"), F.lit(DEFAULT_THRESHOLD))
    return df.withColumn(threshold_col, t).withColumn("reason", threshold_reason(F.col(threshold_col)))


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], accepted_path: str,
                 rejected_path: str, checkpoint: str, validate=prepare_requests,
                 available_now: bool = True):
    """Start the streaming query; returns the StreamingQuery."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        v = validate(batch).persist()
        try:
            ok = scorer(v.filter(F.col("reason").isNull()).drop("reason"))
            ok.write.mode("overwrite").parquet(f"{accepted_path}/batch={batch_id}")
            v.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(
                f"{rejected_path}/batch={batch_id}")
        finally:
            v.unpersist()

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()

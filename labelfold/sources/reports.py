"""Report sinks: detailed predictions and the evaluation report sections.

Every section is a DataFrame written by the executors; nothing of data size
is assembled on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqltext as X
from ..functions.labels import per_label
from ..operators.frame import EvalFrame
from .corpus_io import CSV_READ, CSV_WRITE


def detailed_predictions(ef: EvalFrame, t=0.5, op: str = "gt") -> DataFrame:
    """Text (or keys), then <label>_prob, <label>_pred, <label>_true per label."""
    ts = per_label(t, ef.k)
    cols = [X.ident(c) for c in ef.keys] + (["text"] if "text" in ef.df.columns else [])
    cols += [f"{X.elem('score', i)} AS {X.ident(n + '_prob')}" for i, n in enumerate(ef.names)]
    cols += [f"{X.as_int(X.above(X.elem('score', i), ts[i], op))} AS {X.ident(n + '_pred')}"
             for i, n in enumerate(ef.names)]
    if ef.has_truth:
        cols += [f"CAST({X.elem('y_true', i)} AS DOUBLE) AS {X.ident(n + '_true')}"
                 for i, n in enumerate(ef.names)]
    return ef.df.selectExpr(*cols)


def write_detailed_predictions(ef: EvalFrame, path: str, t=0.5, op: str = "gt",
                               fmt: str = "csv") -> None:
    out = detailed_predictions(ef, t, op)
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.options(**CSV_WRITE).csv(path)
    else:
        w.format(fmt).save(path)


def read_detailed_predictions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The written predictions, with their columns as ``schema`` lists them."""
    return spark.read.schema(schema).options(**CSV_READ).csv(path)


def write_report(sections: dict, path: str, fmt: str = "json") -> list:
    """One folder per section, whatever its size; returns (section, path) pairs."""
    written = []
    for name, df in sections.items():
        target = f"{path}/{name}"
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.options(**CSV_WRITE).csv(target)
        else:
            w.json(target)
        written.append((name, target))
    return written


def read_section(spark: SparkSession, path: str, name: str, fmt: str = "json", schema=None) -> DataFrame:
    """One written section; its types are inferred unless ``schema`` gives them (an empty section has none)."""
    target = f"{path}/{name}"
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.options(**CSV_READ).csv(target) if fmt == "csv" else reader.json(target)


def write_text_report(report: DataFrame, path: str) -> None:
    """The classification report as aligned lines, each after its order."""
    line = F.format_string("%d\t%-16s%12.4f%12.4f%12.4f%12d", "row_order", "row_name", "precision", "recall", "f1",
                           "support")
    report.coalesce(1).select(line.alias("value")).write.mode("overwrite").text(path)

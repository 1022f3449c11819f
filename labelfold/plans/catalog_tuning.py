"""Registered queries that find thresholds from the data, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import thresholds as th
from . import bindings as B
from . import oracle as O
from .catalog import L_NAMES, K, register


def _best_sql(op: str, k: int, src: str = "l") -> str:
    """CTE ``best``: each label's threshold of the highest F1 over all its distinct scores, by single windows."""
    cells = " UNION ALL ".join(f"SELECT {i} AS label_idx, y{i} AS y, p{i} AS p FROM {src}" for i in range(k))
    below = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    f1 = O.sdiv("2 * tp", "2 * tp + fp + fn")
    return (f"tcells AS ({cells}), "
            "tsc AS (SELECT label_idx, p, sum(y) AS pos, sum(1 - y) AS neg FROM tcells GROUP BY 1, 2), "
            f"trk AS (SELECT label_idx, p, lag(p) OVER w AS previous, "
            f"coalesce(sum(pos) OVER (PARTITION BY label_idx ORDER BY p {below}), 0) AS fn, "
            f"coalesce(sum(neg) OVER (PARTITION BY label_idx ORDER BY p {below}), 0) AS tn, "
            "sum(pos) OVER (PARTITION BY label_idx) AS pos_all, sum(neg) OVER (PARTITION BY label_idx) AS neg_all "
            "FROM tsc WINDOW w AS (PARTITION BY label_idx ORDER BY p)), "
            "tcm AS (SELECT label_idx, p, "
            + ("p" if op == "ge" else "coalesce(previous, CAST('-Infinity' AS DOUBLE))") + " AS threshold, "
            "pos_all - fn AS tp, neg_all - tn AS fp, fn, tn FROM trk), "
            f"best AS (SELECT * FROM (SELECT *, {f1} AS f1, row_number() OVER (PARTITION BY label_idx ORDER BY {f1} DESC, p) "
            "AS r FROM tcm) WHERE r = 1)")


def _names_sql(col: str = "label_idx") -> str:
    return f"([{', '.join(O.q(n) for n in L_NAMES)}])[{col} + 1]"


_FOUND = (f"SELECT label_idx, {_names_sql()} AS label, threshold, {O.sdiv('tp', 'tp + fp')} AS precision, "
          f"{O.sdiv('tp', 'tp + fn')} AS recall, f1, {O.sdiv('tp + tn', 'tp + fp + fn + tn')} AS accuracy, "
          + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("tp", "fp", "fn", "tn")) + " FROM best")


@register("best_label_thresholds", f"WITH {O.frame_l_sql()}, {_best_sql('ge', K)} {_FOUND}")
def q_best_label_thresholds(spark, sf):
    return th.best_thresholds(B.frame_l(spark, sf))


@register("best_label_thresholds_gt", f"WITH {O.frame_l_sql()}, {_best_sql('gt', K)} {_FOUND}")
def q_best_label_thresholds_gt(spark, sf):
    return th.best_thresholds(B.frame_l(spark, sf), "gt")


@register("tuned_label_metrics",
          f"WITH {O.frame_l_sql()}, {_best_sql('ge', K)}, cut AS (SELECT c.label_idx, best.threshold, "
          "count_if(c.p >= threshold AND y = 1) AS tp, count_if(c.p >= threshold AND y = 0) AS fp, "
          "count_if(c.p < threshold AND y = 1) AS fn, count_if(c.p < threshold AND y = 0) AS tn "
          "FROM tcells c JOIN best USING (label_idx) GROUP BY 1, 2) "
          f"SELECT label_idx, {_names_sql()} AS label, threshold, {O.sdiv('tp', 'tp + fp')} AS precision, "
          f"{O.sdiv('tp', 'tp + fn')} AS recall, {O.sdiv('2 * tp', '2 * tp + fp + fn')} AS f1, "
          "CAST(tp + fp AS BIGINT) AS predicted_count FROM cut")
def q_tuned_label_metrics(spark, sf):
    """The found thresholds applied to the frame they were found on."""
    ef = B.frame_l(spark, sf)
    ts = th.threshold_list(th.best_thresholds(ef), ef.k)
    limits = F.element_at(F.array(*map(F.lit, ts)), F.col("label_idx") + 1)
    return ev.per_label_metrics(ef, ts, "ge").select(
        "label_idx", "label", limits.alias("threshold"), "precision", "recall", "f1", "predicted_count")

"""Multi-label evaluation (confusion, per-label metrics, averages, overall).

Plan shape: ONE scan of the evaluation frame into ONE global aggregate that
holds, per label, tp/fp/fn/tn and, per row, exact-match and sample P/R/F1
sums.  Spark runs it as a partial aggregate in every scan task plus a
single-row final merge, so nothing grows with the data after the scan and no
key can be hot.  Every table below (K label rows, the overall row, the
report) is a projection of that one row; averages are written as sums in a
fixed label order so they are reproducible bit for bit.

When AUC is wanted as well, the counts come from the AUC plan's table of sums
per label (``auc.label_sums``), so one exchange serves both.  Wide expressions are SQL text (``sqltext``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sqltext as X
from ..functions.labels import per_label
from .frame import EvalFrame


def _row_terms(ef: EvalFrame, t, op: str, pred_col: str | None = None):
    """SQL text of the K predicted bits and the K truth bits."""
    if pred_col is None:
        ts = per_label(t, ef.k)
        h = [X.as_int(X.above(X.elem("score", i), ts[i], op)) for i in range(ef.k)]
    else:
        h = [f"CAST({X.elem(pred_col, i)} AS INT)" for i in range(ef.k)]
    y = [X.elem("y_true", i) for i in range(ef.k)]
    return h, y


def counts_row(ef: EvalFrame, t=0.5, op: str = "gt", pred_col: str | None = None,
               weight: str = "1") -> DataFrame:
    """One row: n, per label tp/fp/fn/tn, exact-match count, sample sums.

    ``pred_col`` names a precomputed 0/1 vector to evaluate instead of
    thresholding the scores (the reference's call without scores).  ``weight`` is
    SQL text of how many rows a row stands for.
    """
    ef.require_truth()
    h, y = _row_terms(ef, t, op, pred_col)

    def rows_with(cond: str) -> str:
        return f"count_if({cond})" if weight == "1" else f"coalesce(sum(CASE WHEN {cond} THEN {weight} ELSE 0 END), 0)"
    aggs = [f"{rows_with('true')} AS n"]
    for i in range(ef.k):
        aggs += [
            f"{rows_with(f'({h[i]}) = {a} AND ({y[i]}) = {b}')} AS {m}_{i}"
            for m, a, b in (("tp", 1, 1), ("fp", 1, 0), ("fn", 0, 1), ("tn", 0, 0))
        ]
    exact = X.all_of([f"({h[i]}) = ({y[i]})" for i in range(ef.k)])
    inter = X.fsum([f"({h[i]}) * ({y[i]})" for i in range(ef.k)])
    nh = X.fsum(h)
    ny = X.fsum(y)
    aggs += [
        f"{rows_with(exact)} AS exact",
        f"sum({X.safe_div(inter, nh)} * {weight}) AS s_precision",
        f"sum({X.safe_div(inter, ny)} * {weight}) AS s_recall",
        f"sum({X.safe_div(f'2 * {inter}', f'{nh} + {ny}')} * {weight}) AS s_f1",
    ]
    return ef.df.agg(*[F.expr(a) for a in aggs])


def _label_metric_cols(i: int) -> dict:
    """SQL text of the per-label metrics over the counts row."""
    return metric_exprs(*(f"{m}_{i}" for m in ("tp", "fp", "fn", "tn")))


def metric_exprs(tp: str, fp: str, fn: str, tn: str, n: str = "n") -> dict:
    """SQL text of one label's metrics from its confusion counts."""
    return {
        "precision": X.safe_div(tp, f"{tp} + {fp}"),
        "recall": X.safe_div(tp, f"{tp} + {fn}"),
        "f1": X.safe_div(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}"),
        "support": f"CAST({tp} + {fn} AS BIGINT)",
        "accuracy": X.safe_div(f"{tp} + {tn}", n),
        "positive_count": f"CAST({tp} + {fn} AS BIGINT)",
        "predicted_count": f"CAST({tp} + {fp} AS BIGINT)",
        "true_positive": f"CAST({tp} AS BIGINT)",
        "false_positive": f"CAST({fp} AS BIGINT)",
        "false_negative": f"CAST({fn} AS BIGINT)",
        "true_negative": f"CAST({tn} AS BIGINT)",
        "specificity": X.safe_div(tn, f"{tn} + {fp}"),
    }


PER_LABEL_COLUMNS = ["precision", "recall", "f1", "support", "accuracy", "positive_count",
                     "predicted_count", "true_positive", "false_positive",
                     "false_negative", "true_negative", "specificity"]


def _label_struct(i: int, name: str, fields: list, m: dict, key: str = "label_idx",
                  name_key: str = "label") -> str:
    return X.named_struct([(key, X.lit(i)), (name_key, X.lit(name))] + [(f, m[f]) for f in fields])


def _unpivot_labels(row: DataFrame, ef: EvalFrame, fields: list, builder) -> DataFrame:
    structs = [_label_struct(i, name, fields, builder(i)) for i, name in enumerate(ef.names)]
    return row.select(X.inline_rows(structs))


def confusion(ef: EvalFrame, t=0.5, op: str = "gt", row: DataFrame | None = None) -> DataFrame:
    """Per label [[tn, fp], [fn, tp]] as columns."""
    row = row if row is not None else counts_row(ef, t, op)

    def b(i):
        return {m: f"CAST({m}_{i} AS BIGINT)" for m in ("tn", "fp", "fn", "tp")}
    return _unpivot_labels(row, ef, ["tn", "fp", "fn", "tp"], b)


def per_label_metrics(ef: EvalFrame, t=0.5, op: str = "gt", row: DataFrame | None = None,
                      pred_col: str | None = None) -> DataFrame:
    """E2; ``pred_col`` evaluates a given 0/1 prediction vector instead of
    thresholding the scores (S16)."""
    row = row if row is not None else counts_row(ef, t, op, pred_col)
    return _unpivot_labels(row, ef, PER_LABEL_COLUMNS, _label_metric_cols)


def _macro(metric: str, k: int) -> str:
    return f"({X.fsum([_label_metric_cols(i)[metric] for i in range(k)])} / {X.lit(float(k))})"


def _micro(k: int) -> dict:
    tp = X.fsum([f"tp_{i}" for i in range(k)])
    fp = X.fsum([f"fp_{i}" for i in range(k)])
    fn = X.fsum([f"fn_{i}" for i in range(k)])
    return {"precision": X.safe_div(tp, f"{tp} + {fp}"), "recall": X.safe_div(tp, f"{tp} + {fn}"),
            "f1": X.safe_div(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}"),
            "support": f"CAST({tp} + {fn} AS BIGINT)"}


def _weighted(metric: str, k: int) -> str:
    num = X.fsum([f"{_label_metric_cols(i)[metric]} * (tp_{i} + fn_{i})" for i in range(k)])
    den = X.fsum([f"tp_{i} + fn_{i}" for i in range(k)])
    return X.safe_div(num, den)


def overall_columns(k: int) -> dict:
    """SQL text of the overall measures over the counts row."""
    fp = X.fsum([f"fp_{i}" for i in range(k)])
    fn = X.fsum([f"fn_{i}" for i in range(k)])
    micro = _micro(k)
    exact = X.safe_div("exact", "n")
    return {
        "exact_match_accuracy": exact,
        "subset_accuracy": exact,
        "hamming_loss": X.safe_div(f"{fp} + {fn}", f"n * {X.lit(k)}"),
        "macro_precision": _macro("precision", k),
        "macro_recall": _macro("recall", k),
        "macro_f1": _macro("f1", k),
        "micro_precision": micro["precision"],
        "micro_recall": micro["recall"],
        "micro_f1": micro["f1"],
    }


def overall_metrics(ef: EvalFrame, t=0.5, op: str = "gt", with_auc: bool = True,
                    auc_partitions: int | None = None, pred_col: str | None = None,
                    sums: DataFrame | None = None) -> DataFrame:
    """E10 overall row: exact match, subset accuracy, Hamming, macro/micro P/R/F1,
    macro AUC (a null per-label AUC counts as 0.5) and the AUC of every label.

    With AUC, everything comes from the AUC plan's table of K + 1 sums, so the
    data is exchanged once.  With ``pred_col`` (a given 0/1 prediction vector,
    S16) there are no scores, so the AUCs are null.  ``sums`` gives that table."""
    cols = overall_columns(ef.k)
    if pred_col is not None:
        return counts_row(ef, t, op, pred_col).selectExpr(
            *[f"{c} AS {n}" for n, c in cols.items()], "CAST(NULL AS DOUBLE) AS macro_auc",
            "CAST(NULL AS ARRAY<DOUBLE>) AS auc_by_label")
    if not with_auc:
        return counts_row(ef, t, op).selectExpr(*[f"{c} AS {n}" for n, c in cols.items()])
    from .auc import AUC_SQL, EXACT, label_sums
    sums = label_sums(ef, t, op, auc_partitions, exact=True) if sums is None else sums
    sums = sums.selectExpr("*", f"{AUC_SQL} AS auc")
    at = lambda i, e: f"coalesce(max(CASE WHEN label_idx = {i} THEN {e} END), 0)"
    aggs = [f"{at(EXACT, 'n_pos')} AS exact", f"{at(EXACT, 'n_pos + n_neg')} AS n"]
    for i in range(ef.k):
        aggs += [f"{at(i, 'tp')} AS tp_{i}", f"{at(i, 'fp')} AS fp_{i}", f"{at(i, 'n_pos - tp')} AS fn_{i}",
                 f"{at(i, 'n_neg - fp')} AS tn_{i}", f"max(CASE WHEN label_idx = {i} THEN auc END) AS auc_{i}"]
    row = sums.agg(*[F.expr(x) for x in aggs])
    total = " + ".join(f"coalesce(auc_{i}, 0.5D)" for i in range(ef.k))
    return row.selectExpr(*[f"{c} AS {n}" for n, c in cols.items()],
                          f"({total}) / {float(ef.k)!r}D AS macro_auc",
                          f"{X.array_of([f'auc_{i}' for i in range(ef.k)])} AS auc_by_label")


def sample_average_cols() -> dict:
    return {m: X.safe_div(f's_{m}', 'n') for m in ("precision", "recall", "f1")}


def averages(ef: EvalFrame, t=0.5, op: str = "gt") -> DataFrame:
    """Micro, macro, weighted and samples averages, one row each."""
    row = counts_row(ef, t, op)
    return row.select(X.inline_rows(_average_structs(ef.k)))


def _report_struct(order: int, name: str, p: str, r: str, f: str, support: str) -> str:
    return X.named_struct([("row_order", X.lit(order)), ("row_name", X.lit(name)),
                           ("precision", p), ("recall", r), ("f1", f), ("support", support)])


def _average_structs(k: int) -> list:
    micro = _micro(k)
    support = micro["support"]
    samples = sample_average_cols()
    rows = [
        ("micro avg", micro["precision"], micro["recall"], micro["f1"]),
        ("macro avg", _macro("precision", k), _macro("recall", k), _macro("f1", k)),
        ("weighted avg", _weighted("precision", k), _weighted("recall", k), _weighted("f1", k)),
        ("samples avg", samples["precision"], samples["recall"], samples["f1"]),
    ]
    return [_report_struct(k + j, name, p, r, f, support) for j, (name, p, r, f) in enumerate(rows)]


def classification_report(ef: EvalFrame, t=0.5, op: str = "gt", row: DataFrame | None = None) -> DataFrame:
    """K label rows, then micro, macro, weighted and samples rows, all
    projected from the one aggregate row."""
    row = row if row is not None else counts_row(ef, t, op)
    structs = []
    for i, name in enumerate(ef.names):
        m = _label_metric_cols(i)
        structs.append(_report_struct(i, name, m["precision"], m["recall"], m["f1"], m["support"]))
    return row.select(X.inline_rows(structs + _average_structs(ef.k)))


def exact_match(ef: EvalFrame, t=0.5, op: str = "gt") -> DataFrame:
    row = counts_row(ef, t, op)
    e = X.safe_div("exact", "n")
    return row.selectExpr(f"{e} AS exact_match_accuracy", f"{e} AS subset_accuracy")


def hamming_loss(ef: EvalFrame, t=0.5, op: str = "gt") -> DataFrame:
    row = counts_row(ef, t, op)
    return row.selectExpr(f"{overall_columns(ef.k)['hamming_loss']} AS hamming_loss")


def evaluate(ef: EvalFrame, t=0.5, op: str = "gt", auc_partitions: int | None = None) -> dict:
    """Overall row, per-label table and confusion table of one threshold.

    Cache ``ef.df`` first when several sections are computed: they share the
    scan only through the cache (each action runs its own plan).
    """
    return {
        "overall": overall_metrics(ef, t, op, True, auc_partitions),
        "per_label": per_label_metrics(ef, t, op),
        "confusion": confusion(ef, t, op),
    }

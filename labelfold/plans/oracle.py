"""DuckDB SQL text for the same queries (the correctness oracle).

Written independently of the Spark plans: plain per-label CASE / count_if
arithmetic, one window for AUC, a cross join with the thresholds for the
sweep, a recursive CTE for early stopping.  Doubles are written with
``::DOUBLE`` because DuckDB reads ``0.7`` as a DECIMAL literal.
"""

from __future__ import annotations

from .bindings import L_LABELS


def d(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def sdiv(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0::DOUBLE ELSE ({a})::DOUBLE / ({b})::DOUBLE END)"


def fsum(parts: list) -> str:
    return "(" + " + ".join(parts) + ")"


K_L = len(L_LABELS)


def frame_l_sql() -> str:
    """CTE ``l``: keys, y0..y3, p0..p3 of frame L."""
    ys = [
        "CAST(l_returnflag = 'R' AS INTEGER)",
        f"CAST(l_discount >= {d(0.05)} AS INTEGER)",
        f"CAST(l_quantity >= {d(25)} AS INTEGER)",
        f"CAST(l_extendedprice >= {d(50000)} AS INTEGER)",
    ]
    ycols = ", ".join(f"{y} AS y{i}" for i, y in enumerate(ys))
    pcols = ", ".join(
        f"CAST((l_orderkey*{31 + i} + l_partkey*{17 + i} + l_linenumber*{7 + i}) % 1000 AS DOUBLE)"
        f" / {d(1000.0)} * {d(0.7)} + {d(0.3)} * CAST(y{i} AS DOUBLE) AS p{i}"
        for i in range(K_L))
    return (f"lb AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {ycols} FROM lineitem), "
            f"l AS (SELECT *, {pcols} FROM lb)")


def pred(i: int, t: float, op: str = "gt", p: str = "p") -> str:
    sign = ">" if op == "gt" else ">="
    return f"({p}{i} {sign} {d(t)})"


def counts_sql(k: int, t: float = 0.5, op: str = "gt", src: str = "l") -> str:
    """CTE ``c``: one row with n and per-label tp/fp/fn/tn."""
    parts = ["CAST(count(*) AS BIGINT) AS n"]
    for i in range(k):
        h = pred(i, t, op)
        parts += [
            f"CAST(count_if({h} AND y{i} = 1) AS BIGINT) AS tp_{i}",
            f"CAST(count_if({h} AND y{i} = 0) AS BIGINT) AS fp_{i}",
            f"CAST(count_if(NOT {h} AND y{i} = 1) AS BIGINT) AS fn_{i}",
            f"CAST(count_if(NOT {h} AND y{i} = 0) AS BIGINT) AS tn_{i}",
        ]
    exact = " AND ".join(f"(CAST({pred(i, t, op)} AS INTEGER) = y{i})" for i in range(k))
    hs = [f"CAST({pred(i, t, op)} AS INTEGER)" for i in range(k)]
    inter = fsum([f"{hs[i]} * y{i}" for i in range(k)])
    nh = fsum(hs)
    ny = fsum([f"y{i}" for i in range(k)])
    parts += [
        f"CAST(count_if({exact}) AS BIGINT) AS exact",
        f"sum({sdiv(inter, nh)}) AS s_precision",
        f"sum({sdiv(inter, ny)}) AS s_recall",
        f"sum({sdiv('2 * ' + inter, nh + ' + ' + ny)}) AS s_f1",
    ]
    return f"c AS (SELECT {', '.join(parts)} FROM {src})"


def label_metric_exprs(i: int) -> dict:
    tp, fp, fn, tn = f"tp_{i}", f"fp_{i}", f"fn_{i}", f"tn_{i}"
    return {
        "precision": sdiv(tp, f"{tp} + {fp}"),
        "recall": sdiv(tp, f"{tp} + {fn}"),
        "f1": sdiv(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}"),
        "support": f"CAST({tp} + {fn} AS BIGINT)",
        "accuracy": sdiv(f"{tp} + {tn}", "n"),
        "positive_count": f"CAST({tp} + {fn} AS BIGINT)",
        "predicted_count": f"CAST({tp} + {fp} AS BIGINT)",
        "true_positive": f"CAST({tp} AS BIGINT)",
        "false_positive": f"CAST({fp} AS BIGINT)",
        "false_negative": f"CAST({fn} AS BIGINT)",
        "true_negative": f"CAST({tn} AS BIGINT)",
        "specificity": sdiv(tn, f"{tn} + {fp}"),
    }


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def macro(metric: str, k: int) -> str:
    return f"({fsum([label_metric_exprs(i)[metric] for i in range(k)])} / {d(k)})"


def micro(k: int) -> dict:
    tp = fsum([f"tp_{i}" for i in range(k)])
    fp = fsum([f"fp_{i}" for i in range(k)])
    fn = fsum([f"fn_{i}" for i in range(k)])
    return {"precision": sdiv(tp, f"{tp} + {fp}"), "recall": sdiv(tp, f"{tp} + {fn}"),
            "f1": sdiv(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}"),
            "support": f"CAST({tp} + {fn} AS BIGINT)"}


def weighted(metric: str, k: int) -> str:
    num = fsum([f"{label_metric_exprs(i)[metric]} * (tp_{i} + fn_{i})" for i in range(k)])
    den = fsum([f"(tp_{i} + fn_{i})" for i in range(k)])
    return sdiv(num, den)


def overall_exprs(k: int) -> dict:
    fp = fsum([f"fp_{i}" for i in range(k)])
    fn = fsum([f"fn_{i}" for i in range(k)])
    m = micro(k)
    return {
        "exact_match_accuracy": sdiv("exact", "n"),
        "subset_accuracy": sdiv("exact", "n"),
        "hamming_loss": sdiv(f"{fp} + {fn}", f"n * {k}"),
        "macro_precision": macro("precision", k),
        "macro_recall": macro("recall", k),
        "macro_f1": macro("f1", k),
        "micro_precision": m["precision"],
        "micro_recall": m["recall"],
        "micro_f1": m["f1"],
    }


def auc_sql(k: int, src: str = "l") -> str:
    """CTE ``auc``: (label_idx, auc) via one window over all cells of a label."""
    cells = " UNION ALL ".join(f"SELECT {i} AS label_idx, y{i} AS y, p{i} AS p FROM {src}"
                               for i in range(k))
    return (f"cells AS ({cells}), "
            "sc AS (SELECT label_idx, p, sum(y) AS pos, sum(1 - y) AS neg FROM cells GROUP BY label_idx, p), "
            "rk AS (SELECT label_idx, pos, neg, coalesce(sum(neg) OVER (PARTITION BY label_idx ORDER BY p "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM sc), "
            "auc AS (SELECT label_idx, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg, "
            "CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN "
            "CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / (2.0::DOUBLE * sum(pos) * sum(neg)) END AS auc "
            "FROM rk GROUP BY label_idx)")


def thresholds_sql(ts) -> str:
    rows = ", ".join(f"({j}, {d(t)})" for j, t in enumerate(ts))
    return f"th AS (SELECT * FROM (VALUES {rows}) AS t(t_idx, threshold))"


def sweep_sql(k: int, ts, op: str = "gt", src: str = "l") -> str:
    """CTE ``sw``: per threshold exact match, macro P/R/F1, Hamming (cross join)."""
    sign = ">" if op == "gt" else ">="
    parts = ["CAST(count(*) AS BIGINT) AS n"]
    for i in range(k):
        h = f"(p{i} {sign} threshold)"
        parts += [f"CAST(count_if({h} AND y{i} = 1) AS BIGINT) AS tp_{i}",
                  f"CAST(count_if({h} AND y{i} = 0) AS BIGINT) AS fp_{i}",
                  f"CAST(count_if(NOT {h} AND y{i} = 1) AS BIGINT) AS fn_{i}"]
    exact = " AND ".join(f"(CAST((p{i} {sign} threshold) AS INTEGER) = y{i})" for i in range(k))
    parts.append(f"CAST(count_if({exact}) AS BIGINT) AS exact")
    ov = overall_exprs(k)
    cols = ", ".join(f"{ov[m]} AS {m}" for m in ("macro_precision", "macro_recall", "macro_f1",
                                                 "hamming_loss"))
    return (f"{thresholds_sql(ts)}, swc AS (SELECT t_idx, threshold, {', '.join(parts)} "
            f"FROM {src} CROSS JOIN th GROUP BY t_idx, threshold), "
            f"sw AS (SELECT t_idx, threshold, {sdiv('exact', 'n')} AS exact_match_accuracy, {cols} FROM swc)")


def names_of(names, bit_exprs, empty_as=None) -> str:
    parts = ", ".join(f"CASE WHEN {b} = 1 THEN {q(n)} END" for n, b in zip(names, bit_exprs))
    s = f"concat_ws(',', {parts})"
    if empty_as is None:
        return s
    return f"(CASE WHEN {s} = '' THEN {q(empty_as)} ELSE {s} END)"


def hist_sql(k: int, bins: int, src: str = "l") -> str:
    cells = " UNION ALL ".join(f"SELECT {i} AS label_idx, p{i} AS p FROM {src}" for i in range(k))
    b = d(bins)
    e = lambda j: f"(CASE WHEN {j} = {bins} THEN hi2 ELSE CAST({j} AS DOUBLE) * step + lo2 END)"
    return (
        f"hc AS ({cells}), "
        "hr AS (SELECT label_idx, min(p) AS lo, max(p) AS hi FROM hc GROUP BY label_idx), "
        "hr2 AS (SELECT label_idx, CASE WHEN lo = hi THEN lo - 0.5::DOUBLE ELSE lo END AS lo2, "
        "CASE WHEN lo = hi THEN hi + 0.5::DOUBLE ELSE hi END AS hi2 FROM hr), "
        f"hr3 AS (SELECT *, (hi2 - lo2) / {b} AS step, {b} / (hi2 - lo2) AS norm FROM hr2), "
        "hb0 AS (SELECT c.label_idx, c.p, r.lo2, r.hi2, r.step, "
        f"CASE WHEN CAST(floor((c.p - r.lo2) * r.norm) AS INTEGER) = {bins} THEN {bins - 1} "
        "ELSE CAST(floor((c.p - r.lo2) * r.norm) AS INTEGER) END AS i0 FROM hc c JOIN hr3 r USING (label_idx)), "
        f"hb1 AS (SELECT *, CASE WHEN p < {e('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM hb0), "
        f"hb2 AS (SELECT label_idx, CASE WHEN p >= {e('i1 + 1')} AND i1 <> {bins - 1} THEN i1 + 1 ELSE i1 END AS bin FROM hb1), "
        "hcnt AS (SELECT label_idx, bin, count(*) AS cnt FROM hb2 GROUP BY label_idx, bin), "
        f"hgrid AS (SELECT r.label_idx, r.lo2, r.hi2, r.step, g.bin FROM hr3 r CROSS JOIN range(0, {bins}) AS g(bin)), "
        "hist AS (SELECT g.label_idx, CAST(g.bin AS INTEGER) AS bin, CAST(g.bin AS DOUBLE) * g.step + g.lo2 AS bin_lo, "
        f"CASE WHEN g.bin = {bins - 1} THEN g.hi2 ELSE CAST(g.bin + 1 AS DOUBLE) * g.step + g.lo2 END AS bin_hi, "
        "CAST(coalesce(c.cnt, 0) AS BIGINT) AS count FROM hgrid g LEFT JOIN hcnt c "
        "ON c.label_idx = g.label_idx AND c.bin = g.bin)")

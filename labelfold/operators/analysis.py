"""Error analysis: threshold sweep, best threshold, per-label report,
prediction distribution, label combinations, hard examples, histograms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import per_label
from ..functions import sqltext as X
from ..session import scratch_path
from . import auc as auc_ops
from . import frequent
from . import evaluate as ev
from .frame import EvalFrame

# The reference sweeps np.arange(0.1, 1.0, 0.1); we use the decimal literals.
DEFAULT_THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)


def threshold_sweep(ef: EvalFrame, thresholds: Sequence[float] = DEFAULT_THRESHOLDS,
                    op: str = "gt") -> DataFrame:
    """Exact match, macro P/R/F1 and Hamming for every threshold, in one scan.

    Each cell is reduced to r = #thresholds below its score (predicted positive
    at the j-th sorted threshold iff j < r) and each row to the interval
    [a, b) of thresholds at which the whole row is right.  One aggregate over
    (kind, x1, x2) leaves at most K*2*(|T|+1) + (|T|+1)^2 rows: the shuffle
    does not grow with the data or with a cross join over thresholds.
    """
    ef.require_truth()
    k = ef.k
    lo, hi = _row_bounds(ef)
    uniq, incl = sorted({float(t) for t in thresholds}), op == "ge"
    y = [X.elem("y_true", i) for i in range(k)]
    p = [X.score_or_lowest(X.elem("score", i)) for i in range(k)]
    # stage 1: per-row scalars (each computed once, referenced by name later)
    stage = ef.df.selectExpr(*[f"{y[i]} AS _y{i}" for i in range(k)],
                             *[f"{p[i]} AS _p{i}" for i in range(k)],
                             f"{lo} AS _lo", f"{hi} AS _hi")
    # stage 2: ranks against the sorted thresholds (a log2|T|-deep CASE tree)
    stage = stage.selectExpr(
        *[f"_y{i}" for i in range(k)],
        *[f"{X.count_below(f'_p{i}', uniq, incl)} AS _r{i}" for i in range(k)],
        *[f"{e} AS {n}" for n, e in zip(("_a", "_b"), _right_between("_lo", "_hi", uniq, incl))])
    cells = [X.named_struct([("kind", X.lit(i)), ("x1", f"_y{i}"), ("x2", f"_r{i}")]) for i in range(k)]
    row_rec = X.named_struct([("kind", X.lit(-1)), ("x1", "_a"), ("x2", "_b")])
    small = (stage.select(X.inline_rows(cells + [row_rec]))
             .groupBy("kind", "x1", "x2").agg(F.count(F.lit(1)).alias("cnt")))
    return sweep_of_counts(small, k, thresholds)


def _row_bounds(ef: EvalFrame) -> tuple[str, str]:
    """SQL text of a row's highest score of a false label and lowest of a true one."""
    p = [X.score_or_lowest(X.elem("score", i)) for i in range(ef.k)]
    neg, pos = ([f"CASE WHEN {X.elem('y_true', i)} = {v} THEN {p[i]} END" for i in range(ef.k)] for v in (0, 1))
    return ((f"greatest({', '.join(neg)})", f"least({', '.join(pos)})") if ef.k > 1 else (neg[0], pos[0]))


def _right_between(lo: str, hi: str, uniq: Sequence[float], inclusive: bool) -> tuple[str, str]:
    """SQL text of [a, b): the sorted thresholds at which a row with these bounds is wholly right."""
    return (f"CASE WHEN {lo} IS NULL THEN 0 ELSE {X.count_below(lo, uniq, inclusive)} END",
            f"CASE WHEN {hi} IS NULL THEN {len(uniq)} ELSE {X.count_below(hi, uniq, inclusive)} END")


def sweep_of_counts(small: DataFrame, k: int, thresholds: Sequence[float]) -> DataFrame:
    """E12 from (kind, x1, x2, cnt): kind i counts label i's cells of truth x1 and rank x2, kind -1 the rows
    that are right at the sorted thresholds [x1, x2)."""
    ts_in = [float(t) for t in thresholds]
    uniq = sorted(set(ts_in))
    j_of = [uniq.index(t) for t in ts_in]
    grid = small.selectExpr("*", f"explode(sequence(0, {len(ts_in) - 1})) AS t_idx")
    j = f"{X.array_of([X.lit(v) for v in j_of])}[t_idx]"
    hit = f"x2 > {j}"
    exact_hit = f"(x1 <= {j}) AND ({j} < x2)"
    aggs = ["sum(CASE WHEN kind < 0 THEN cnt ELSE 0 END) AS n",
            f"sum(CASE WHEN kind < 0 AND {exact_hit} THEN cnt ELSE 0 END) AS exact"]
    aggs += [f"sum(CASE WHEN kind = {i} AND x1 = 1 AND {hit} THEN cnt ELSE 0 END) AS tp_{i}" for i in range(k)]
    aggs += [f"sum(CASE WHEN kind = {i} AND x1 = 0 AND {hit} THEN cnt ELSE 0 END) AS fp_{i}" for i in range(k)]
    aggs += [f"sum(CASE WHEN kind = {i} AND x1 = 1 THEN cnt ELSE 0 END) AS pos_{i}" for i in range(k)]
    per_t = grid.groupBy("t_idx").agg(*[F.expr(a) for a in aggs])
    per_t = per_t.selectExpr("*", *[f"pos_{i} - tp_{i} AS fn_{i}" for i in range(k)])
    ov = ev.overall_columns(k)
    return per_t.selectExpr(
        "t_idx", f"{X.array_of([X.lit(v) for v in ts_in])}[t_idx] AS threshold",
        f"{X.safe_div('exact', 'n')} AS exact_match_accuracy",
        *[f"{ov[m]} AS {m}" for m in ("macro_precision", "macro_recall", "macro_f1", "hamming_loss")])


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first threshold (list order) with the highest macro F1."""
    best = F.max_by(F.struct("threshold", "t_idx", "macro_f1"),
                    F.struct(F.col("macro_f1"), -F.col("t_idx")))
    return sweep.agg(best.alias("b")).select("b.t_idx", "b.threshold", "b.macro_f1")


def per_label_report(ef: EvalFrame, t=0.5, op: str = "gt", auc_partitions: int | None = None,
                     sums: DataFrame | None = None) -> DataFrame:
    """Per-label metrics + AUC (null shown as 0.5) + description, ranked by F1.

    Metrics and AUC both come from the AUC plan's table of sums (K rows; ``sums``
    when it is there already), so the data is exchanged once."""
    sums = auc_ops.label_sums(ef, t, op, auc_partitions) if sums is None else sums.filter("label_idx >= 0")
    m = ev.metric_exprs("tp", "fp", "(n_pos - tp)", "(n_neg - fp)", "(n_pos + n_neg)")
    names = X.array_of([X.lit(n) for n in ef.names])
    dic = ef.labels.to_frame(ef.df.sparkSession).select("label_idx", "label_en", "description")
    # one row per label on both sides: the broadcast is bounded by K
    rep = (sums.selectExpr(
        "label_idx", f"{names}[label_idx] AS label", *[f"{m[c]} AS {c}" for c in ev.PER_LABEL_COLUMNS],
        f"coalesce({auc_ops.AUC_SQL}, 0.5D) AS auc").join(F.broadcast(dic), "label_idx"))
    rank = F.row_number().over(Window.orderBy(F.col("f1").desc(), F.col("label_idx")))
    return rep.withColumn("rank", rank)


def prediction_distribution(ef: EvalFrame, t=0.5, op: str = "gt", truth: bool = False) -> DataFrame:
    """E15 (and C1/C2 on the truth when ``truth``): per-label counts plus the
    per-row cardinality summary, from one aggregate."""
    vec = X.ident("y_true") if truth else X.binarize("score", ef.k, per_label(t, ef.k), op)
    return distribution_of_vectors(ef.df.selectExpr(f"{vec} AS vec", "1L AS copies"), ef.names)


def distribution_of_vectors(vectors: DataFrame, names: Sequence[str]) -> DataFrame:
    """E15 of (vec, copies): label vectors and how many rows have each (one vector may come several times)."""
    k = len(names)
    card = X.vector_sum("vec", k)
    # a frame without rows has no rows "without labels", as count_if says it
    aggs = ["coalesce(sum(copies), 0) AS n", f"sum({card} * copies) AS card_sum", f"max({card}) AS card_max",
            f"coalesce(sum(CASE WHEN {card} = 0 THEN copies ELSE 0 END), 0) AS none",
            f"coalesce(sum(CASE WHEN {card} > 1 THEN copies ELSE 0 END), 0) AS several"]
    aggs += [f"sum({X.vec_elem('vec', i)} * copies) AS c_{i}" for i in range(k)]
    row = vectors.agg(*[F.expr(a) for a in aggs])
    structs = [X.named_struct([("label_idx", X.lit(i)), ("label", X.lit(n)),
                               ("predicted_count", f"CAST(c_{i} AS BIGINT)")])
               for i, n in enumerate(names)]
    return row.selectExpr(
        f"inline({X.array_of(structs)})",
        "CAST(n AS BIGINT) AS total_samples",
        f"{X.safe_div('card_sum', 'n')} AS avg_labels_per_sample",
        "CAST(card_max AS BIGINT) AS max_labels_per_sample",
        "CAST(none AS BIGINT) AS samples_with_no_labels",
        "CAST(several AS BIGINT) AS samples_with_multiple_labels")


def label_combinations(ef: EvalFrame, t=0.5, op: str = "gt", top: int = 10,
                       truth: bool = False, empty_as: str = "clean", counters: int | None = None) -> DataFrame:
    """Most frequent exact label sets, count and share of rows.

    ``groupBy(vector)`` is a partial + final aggregate (at most 2^K groups);
    the top-k is a TakeOrderedAndProject, the total a union with one row and a
    window over those k+1 rows, so no join and no global sort.  With many labels
    nearly every set may differ: ``counters`` then bounds what a task holds
    (``frequent.top_counts``, the same result).
    """
    k = ef.k
    vec = X.ident("y_true") if truth else X.binarize("score", k, per_label(t, k), op)
    keys = ef.df.select(F.expr(X.vector_key(vec, k)).alias("vector"))
    if counters is not None:
        found, n, _ = frequent.top_counts(keys, "vector", top, counters)
        total = ef.df.sparkSession.range(1).select(F.lit(n).cast("long").alias("count"))
        return ranked_combinations(found, total, ef.names, top, empty_as)
    groups = keys.groupBy("vector").agg(F.count(F.lit(1)).alias("count"))
    return ranked_combinations(groups, groups.agg(F.sum("count").alias("count")), ef.names, top, empty_as)


def ranked_combinations(groups: DataFrame, total: DataFrame, names: Sequence[str], top: int = 10,
                        empty_as: str = "clean") -> DataFrame:
    """E16 of (vector, count), one row per label set, and the one row of all rows' ``count``."""
    top_rows = (groups.orderBy(F.col("count").desc(), F.col("vector").desc()).limit(top)
                .withColumn("kind", F.lit("top")))
    total = total.select(
        F.lit(None).cast("string").alias("vector"), "count", F.lit("total").alias("kind"))
    both = top_rows.unionByName(total)
    w = Window.partitionBy(F.lit(0))
    n = F.max(F.when(F.col("kind") == "total", F.col("count"))).over(w)
    ranked = both.withColumn("n", n).filter(F.col("kind") == "top")
    names_of = "transform(split(vector, ','), x -> CAST(x AS INT))"
    rank = F.row_number().over(Window.orderBy(F.col("count").desc(), F.col("vector").desc()))
    return ranked.select(
        rank.alias("rank"), F.expr(X.decode_names(names_of, names, empty_as)).alias("labels"), "vector",
        F.col("count").cast("long").alias("count"),
        (F.col("count") / F.col("n") * F.lit(100.0)).alias("percentage"))


HARD_ROUND = 12


def hard_examples(ef: EvalFrame, n: int = 20, empty_as: str = "clean",
                  text: bool = False) -> DataFrame:
    """Rows ranked by hardness = 0.5*(1 - confidence) + 0.5*[any label
    wrong at 0.5], confidence = mean |p - 0.5|; top n, ties by key descending.
    A TakeOrderedAndProject: each task keeps n rows, nothing is sorted globally."""
    k = ef.k
    dist = [f"abs({X.elem('score', i)} - 0.5D)" for i in range(k)]
    conf = f"({' + '.join(dist)}) / {X.lit(float(k))}"
    h = X.binarize("score", k, [0.5] * k, "gt")
    correct = X.all_of([f"{X.vec_elem(h, i)} = {X.elem('y_true', i)}" for i in range(k)])
    base = ef.df.select(
        *ef.keys, *(["text"] if text else []), "y_true", "score",
        F.expr(h).alias("y_pred"), F.expr(conf).alias("confidence"), F.expr(correct).alias("is_correct"))
    base = base.withColumn("hardness", F.expr(
        f"round((1.0D - confidence) * 0.5D + CASE WHEN is_correct THEN 0.0D ELSE 0.5D END, {HARD_ROUND})"))
    order = [F.col("hardness").desc()] + [F.col(c).desc() for c in ef.keys]
    top = base.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.orderBy(*order))
    return top.select(
        rank.alias("rank"), *ef.keys, *(["text"] if text else []),
        F.expr(X.decode_names(X.ident("y_true"), ef.names, empty_as)).alias("true_labels"),
        F.expr(X.decode_names(X.ident("y_pred"), ef.names, empty_as)).alias("predicted_labels"),
        F.expr(f"round(confidence, {HARD_ROUND})").alias("confidence"),
        F.expr("CAST(is_correct AS INT)").alias("is_correct"),
        "hardness",
        *[F.expr(f"{X.elem('score', i)} AS prob_{i}") for i in range(k)])


def histogram_range(lo: float, hi: float, bins: int) -> tuple:
    """(lo2, hi2, step, norm) of numpy.histogram; lo == hi widens to +-0.5
    (IEEE double arithmetic, the same values the JVM would compute)."""
    lo2, hi2 = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    return lo2, hi2, (hi2 - lo2) / float(bins), float(bins) / (hi2 - lo2)


def histogram_bin_stages(p: str, rng: tuple, bins: int, i: int) -> tuple:
    """SQL text of numpy.histogram's bin of p in three stages, each a column
    of the previous select (_i0_i, _i1_i, bin_i): equal bins, last one closed,
    with numpy's corrections for values that fall on an edge after rounding.  The
    range's entries are numbers or SQL text."""
    lo2, hi2, step, norm = (v if isinstance(v, str) else X.lit(float(v)) for v in rng)

    def edge(j):
        return f"CASE WHEN {j} = {bins} THEN {hi2} ELSE CAST({j} AS DOUBLE) * {step} + {lo2} END"
    i0 = f"CAST(floor(({p} - {lo2}) * {norm}) AS INT)"
    return (f"CASE WHEN {i0} = {bins} THEN {bins - 1} ELSE {i0} END",
            f"CASE WHEN {p} < {edge(f'_i0_{i}')} THEN _i0_{i} - 1 ELSE _i0_{i} END",
            f"CASE WHEN {p} >= {edge(f'_i1_{i} + 1')} AND _i1_{i} != {bins - 1} "
            f"THEN _i1_{i} + 1 ELSE _i1_{i} END")


def score_histogram(ef: EvalFrame, bins: int = 50) -> DataFrame:
    """Per-label equal-width histogram over that label's [min, max].

    Pass 1: one aggregate of min/max per label; the K ranges (bounded by K,
    like model parameters) come back as literals.  Pass 2: every row computes
    its K bins in the wide frame (no join, no explode of the scores), emits K
    (label, bin) pairs and one partial+final aggregate counts them.  Empty
    bins come from a K*bins grid merged by union + aggregate.
    """
    k = ef.k
    present = [f"CASE WHEN NOT isnan({X.elem('score', i)}) THEN {X.elem('score', i)} END" for i in range(k)]
    ext = ef.df.agg(*[F.expr(f"{fn}({present[i]}) AS {fn}_{i}") for i in range(k) for fn in ("min", "max")]).collect()[0]
    labels = list(range(k))
    # a label without any score has empty bins over [0, 1], as numpy gives an empty array
    rng = {i: histogram_range(*((0.0, 1.0) if ext[f"min_{i}"] is None else
                                (float(ext[f"min_{i}"]), float(ext[f"max_{i}"]))), bins) for i in labels}
    stages = {i: histogram_bin_stages(present[i], rng[i], bins, i) for i in labels}
    d = ef.df.selectExpr("score", *[f"{stages[i][0]} AS _i0_{i}" for i in labels])
    d = d.selectExpr("score", *[f"_i0_{i}" for i in labels], *[f"{stages[i][1]} AS _i1_{i}" for i in labels])
    d = d.selectExpr(*[f"{stages[i][2]} AS bin_{i}" for i in labels])
    pairs = [X.named_struct([("label_idx", X.lit(i)), ("bin", f"bin_{i}")]) for i in labels]
    counts = (d.select(X.inline_rows(pairs)).filter("bin IS NOT NULL").groupBy("label_idx", "bin")
              .agg(F.count(F.lit(1)).alias("count")))
    ids = X.array_of([X.lit(i) for i in labels])
    grid = ef.df.sparkSession.range(len(labels) * bins).selectExpr(
        f"{ids}[CAST(id DIV {bins} AS INT)] AS label_idx", f"CAST(id % {bins} AS INT) AS bin",
        "CAST(0 AS BIGINT) AS count")
    merged = counts.unionByName(grid).groupBy("label_idx", "bin").agg(F.sum("count").alias("count"))

    def per_label(j):
        return X.array_of([X.lit(float(rng[i][j])) if i in rng else "CAST(NULL AS DOUBLE)" for i in range(k)])
    lo2, hi2, step = per_label(0), per_label(1), per_label(2)
    names = X.array_of([X.lit(n) for n in ef.names])
    return merged.selectExpr(
        "label_idx", f"{names}[label_idx] AS label", "bin",
        f"CAST(bin AS DOUBLE) * {step}[label_idx] + {lo2}[label_idx] AS bin_lo",
        f"CASE WHEN bin = {bins - 1} THEN {hi2}[label_idx] "
        f"ELSE CAST(bin + 1 AS DOUBLE) * {step}[label_idx] + {lo2}[label_idx] END AS bin_hi",
        "CAST(count AS BIGINT) AS count")


def histogram_of_counts(scores: DataFrame, names: Sequence[str], bins: int = 50) -> DataFrame:
    """E19 of (label_idx, p, pos, neg), one row per label and distinct score; minus infinity stands for a
    missing score and lies in no bin."""
    k = len(names)
    seen = scores.filter("label_idx >= 0 AND p > CAST('-Infinity' AS DOUBLE)")
    ends = seen.groupBy("label_idx").agg(F.min("p").alias("lo"), F.max("p").alias("hi"))
    labels = scores.sparkSession.range(k).selectExpr("CAST(id AS INT) AS label_idx")
    ranges = (labels.join(ends, "label_idx", "left")
              .selectExpr("label_idx", "coalesce(lo, 0.0D) AS lo", "coalesce(hi, 1.0D) AS hi")
              .selectExpr("label_idx", "CASE WHEN lo = hi THEN lo - 0.5D ELSE lo END AS lo2",
                          "CASE WHEN lo = hi THEN hi + 0.5D ELSE hi END AS hi2")
              .selectExpr("*", f"(hi2 - lo2) / {float(bins)!r}D AS step", f"{float(bins)!r}D / (hi2 - lo2) AS norm"))
    stages = histogram_bin_stages("p", ("lo2", "hi2", "step", "norm"), bins, 0)
    # both sides of every join below have K rows or are cut to K x bins
    d = seen.join(F.broadcast(ranges), "label_idx")
    for name, stage in zip(("_i0_0", "_i1_0", "bin"), stages):
        d = d.withColumn(name, F.expr(stage))
    counts = d.groupBy("label_idx", "bin").agg(F.sum(F.expr("pos + neg")).alias("count"))
    grid = labels.selectExpr("label_idx", f"explode(sequence(0, {bins - 1})) AS bin", "0L AS count")
    merged = counts.unionByName(grid).groupBy("label_idx", "bin").agg(F.sum("count").alias("count"))
    label_names = X.array_of([X.lit(n) for n in names])
    return merged.join(F.broadcast(ranges), "label_idx").selectExpr(
        "label_idx", f"{label_names}[label_idx] AS label", "bin", "CAST(bin AS DOUBLE) * step + lo2 AS bin_lo",
        f"CASE WHEN bin = {bins - 1} THEN hi2 ELSE CAST(bin + 1 AS DOUBLE) * step + lo2 END AS bin_hi", "count")


def report_counts(ef: EvalFrame, t=0.5, op: str = "gt",
                  thresholds: Sequence[float] = DEFAULT_THRESHOLDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What every counted section of a report needs, from one scan and one aggregate, written once.

    Each row gives K score cells and its exact-match bit (as ``auc``), the sorted thresholds at which it is
    wholly right, and its pair of predicted and true vectors; all are counted together, combined in the scan
    tasks.  Returns (label_idx, p, pos, neg), (x1, x2, cnt) and (y_pred, y_true, copies)."""
    ef.require_truth()
    ts = per_label(t, ef.k)
    lo, hi = _row_bounds(ef)
    a, b = _right_between(lo, hi, sorted({float(x) for x in thresholds}), op == "ge")
    one = X.named_struct([("label_idx", "0"), ("p", "0.0D"), ("pos", "1L"), ("neg", "0L")])

    def record(part, v=one, x1="0", x2="0", pred="CAST(NULL AS ARRAY<INT>)", true="CAST(NULL AS ARRAY<INT>)"):
        return X.named_struct([("part", X.lit(part)), ("v", v), ("x1", x1), ("x2", x2), ("y_pred", pred), ("y_true", true)])
    records = [record("scores", c) for c in (*auc_ops.truth_cells(ef), auc_ops.exact_cell(ef, ts, op))]
    records += [record("rows", x1=a, x2=b),
                record("vectors", pred=X.binarize("score", ef.k, ts, op), true=X.ident("y_true"))]
    spark = ef.df.sparkSession
    path = scratch_path(spark, "report-counts")
    (ef.df.select(X.inline_rows(records)).select("part", "v.*", "x1", "x2", "y_pred", "y_true")
     .groupBy("part", "label_idx", "p", "x1", "x2", "y_pred", "y_true")
     .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).write.partitionBy("part").parquet(path))
    whole = spark.read.schema("label_idx int, p double, x1 int, x2 int, y_pred array<int>, y_true array<int>, "
                              "pos long, neg long, part string").parquet(path)
    part = {name: whole.filter(F.col("part") == name) for name in ("scores", "rows", "vectors")}
    return (part["scores"].select("label_idx", "p", "pos", "neg"),
            part["rows"].select("x1", "x2", F.col("pos").alias("cnt")),
            part["vectors"].select("y_pred", "y_true", F.col("pos").alias("copies")))


def evaluation_report(ef: EvalFrame, path: str, t=0.5, op: str = "gt",
                      thresholds: Sequence[float] = DEFAULT_THRESHOLDS, hard_n: int = 20,
                      bins: int = 50) -> DataFrame:
    """Every section of the evaluation written under ``path``.

    The frame is read three times: once for the counts from which all counted
    sections are cut (``report_counts``), once for the hard examples and once for the
    detailed predictions, which the executors write directly.  Returns (section, path)
    of the written sections."""
    from ..sources.reports import read_section, write_detailed_predictions, write_report, write_text_report

    spark = ef.df.sparkSession
    scores, rows, vectors = report_counts(ef, t, op, thresholds)
    row = ev.counts_row(ef.with_df(vectors), t, op, pred_col="y_pred", weight="copies")
    row.write.mode("overwrite").parquet(f"{path}/counts")
    row = spark.read.parquet(f"{path}/counts")
    sums_at = scratch_path(spark, "report-sums")
    auc_ops.sums_of_counts(scores, per_label(t, ef.k), op).write.parquet(sums_at)
    sums = spark.read.parquet(sums_at)
    rank = X.count_below("p", sorted({float(x) for x in thresholds}), op == "ge")
    cells = scores.filter("label_idx >= 0").selectExpr(
        "label_idx AS kind", f"{rank} AS x2", "inline(array(named_struct('x1', 1, 'cnt', pos), named_struct('x1', 0, 'cnt', neg)))")
    small = cells.unionByName(rows.withColumn("kind", F.lit(-1))).groupBy("kind", "x1", "x2").agg(F.sum("cnt").alias("cnt"))
    predicted = vectors.groupBy("y_pred").agg(F.sum("copies").alias("copies")).withColumnRenamed("y_pred", "vec")
    sets = predicted.select(F.expr(X.vector_key("vec", ef.k)).alias("vector"), F.col("copies").alias("count"))
    report = ev.classification_report(ef, t, op, row=row)
    sections = {
        "overall": ev.overall_metrics(ef, t, op, sums=sums),
        "per_label": per_label_report(ef, t, op, sums=sums),
        "confusion": ev.confusion(ef, t, op, row=row),
        "classification_report": report,
        "threshold_sweep": sweep_of_counts(small, ef.k, thresholds),
        "prediction_distribution": distribution_of_vectors(predicted, ef.names),
        "top_label_combinations": ranked_combinations(sets, sets.agg(F.sum("count").alias("count")), ef.names),
        "hard_examples": hard_examples(ef, hard_n, text="text" in ef.df.columns),
        "score_histogram": histogram_of_counts(scores, ef.names, bins),
    }
    written = write_report(sections, path)
    again = {n: read_section(spark, path, n, schema=sections[n].schema) for n in ("threshold_sweep", "per_label")}
    written += write_report({"best_threshold": best_threshold(again["threshold_sweep"])}, path)
    written += write_report({"per_label_csv": again["per_label"]}, path, "csv")
    write_text_report(report, f"{path}/report_text")
    write_detailed_predictions(ef, f"{path}/detailed_predictions", t, op)
    return spark.createDataFrame(written, "section string, path string")

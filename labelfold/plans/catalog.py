"""Registered queries: one Spark plan per operator, each with its DuckDB text.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Every query reads the driver tables (whole tables, no row caps) through the
bindings, so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import auc as auc_ops
from ..operators import evaluate as ev
from . import bindings as B
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


K = O.K_L
L_NAMES = list(B.L_LABELS)


def _labels_union(exprs_of, fields: list, src: str = "c") -> str:
    parts = []
    for i, name in enumerate(L_NAMES):
        e = exprs_of(i)
        cols = ", ".join(f"{e[f]} AS {f}" for f in fields)
        parts.append(f"SELECT {i} AS label_idx, {O.q(name)} AS label, {cols} FROM {src}")
    return " UNION ALL ".join(parts)


# --- E1/E2: flagship -----------------------------------------------------------

@register("per_label_metrics",
          f"WITH {O.frame_l_sql()}, {O.counts_sql(K)} "
          + _labels_union(O.label_metric_exprs, ev.PER_LABEL_COLUMNS))
def q_per_label_metrics(spark, sf):
    return ev.per_label_metrics(B.frame_l(spark, sf), 0.5, "gt")


@register("confusion_matrix",
          f"WITH {O.frame_l_sql()}, {O.counts_sql(K)} "
          + _labels_union(lambda i: {m: f"CAST({m}_{i} AS BIGINT)" for m in ("tn", "fp", "fn", "tp")},
                          ["tn", "fp", "fn", "tp"]))
def q_confusion(spark, sf):
    return ev.confusion(B.frame_l(spark, sf), 0.5, "gt")


@register("per_label_metrics_ge",
          f"WITH {O.frame_l_sql()}, {O.counts_sql(K, 0.5, 'ge')} "
          + _labels_union(O.label_metric_exprs, ev.PER_LABEL_COLUMNS))
def q_per_label_metrics_ge(spark, sf):
    return ev.per_label_metrics(B.frame_l(spark, sf), 0.5, "ge")


# --- E3, E4, E5, E8, E9, E10 ---------------------------------------------------

def _overall_sql() -> str:
    ov = O.overall_exprs(K)
    cols = ", ".join(f"{e} AS {n}" for n, e in ov.items())
    auc_fill = O.fsum([f"(SELECT coalesce(auc, 0.5::DOUBLE) FROM auc WHERE label_idx = {i})"
                       for i in range(K)])
    return (f"WITH {O.frame_l_sql()}, {O.counts_sql(K)}, {O.auc_sql(K)} "
            f"SELECT {cols}, {auc_fill} / {O.d(K)} AS macro_auc, "
            + ", ".join(f"(SELECT auc FROM auc WHERE label_idx = {i}) AS auc_{i}" for i in range(K)) + " FROM c")


@register("overall_metrics", _overall_sql())
def q_overall(spark, sf):
    overall = ev.overall_metrics(B.frame_l(spark, sf), 0.5, "gt")
    return overall.select(*[c for c in overall.columns if c != "auc_by_label"],
                          *[F.col("auc_by_label")[i].alias(f"auc_{i}") for i in range(K)])


# scores made nearly unique per row: nothing repeats, so nothing combines before the exchange
CONTINUOUS = "{p} + CAST(l_orderkey * 8 + l_linenumber AS DOUBLE) * {unit}"


@register("roc_auc_continuous",
          f"WITH {O.frame_l_sql().replace('l AS (SELECT', 'l0 AS (SELECT', 1)}, l AS (SELECT * REPLACE ("
          + ", ".join(CONTINUOUS.format(p=f"p{i}", unit="1e-9::DOUBLE") + f" AS p{i}" for i in range(K))
          + f") FROM l0), {O.auc_sql(K)} SELECT label_idx, auc, n_pos, n_neg FROM auc")
def q_roc_auc_continuous(spark, sf):
    ef = B.frame_l(spark, sf)
    p = ", ".join(CONTINUOUS.format(p=f"score[{i}]", unit="1e-9D") for i in range(ef.k))
    return auc_ops.roc_auc(ef.with_df(ef.df.withColumn("score", F.expr(f"array({p})")))).drop("label")


@register("roc_auc",
          f"WITH {O.frame_l_sql()}, {O.auc_sql(K)} SELECT a.label_idx, "
          f"(['{L_NAMES[0]}', '{L_NAMES[1]}', '{L_NAMES[2]}', '{L_NAMES[3]}'])[a.label_idx + 1] AS label, "
          "a.auc, a.n_pos, a.n_neg FROM auc a")
def q_roc_auc(spark, sf):
    return auc_ops.roc_auc(B.frame_l(spark, sf))


ROUND = 9  # digits compared where sums of doubles depend on the order of rows; operators round nothing


def rounded_samples(report: DataFrame) -> DataFrame:
    """The report with its samples averages (sums of per-row ratios) rounded for the comparison."""
    return report.withColumns({c: F.when(F.col("row_name") == "samples avg", F.round(c, ROUND)).otherwise(F.col(c))
                               for c in ("precision", "recall", "f1")})


def _report_sql() -> str:
    rows = []
    for i, name in enumerate(L_NAMES):
        e = O.label_metric_exprs(i)
        rows.append(f"SELECT {i} AS row_order, {O.q(name)} AS row_name, {e['precision']} AS precision, "
                    f"{e['recall']} AS recall, {e['f1']} AS f1, {e['support']} AS support FROM c")
    m = O.micro(K)
    sup = m["support"]
    avg_rows = [
        ("micro avg", m["precision"], m["recall"], m["f1"]),
        ("macro avg", O.macro("precision", K), O.macro("recall", K), O.macro("f1", K)),
        ("weighted avg", O.weighted("precision", K), O.weighted("recall", K), O.weighted("f1", K)),
        ("samples avg", f"round({O.sdiv('s_precision', 'n')}, {ROUND})",
         f"round({O.sdiv('s_recall', 'n')}, {ROUND})", f"round({O.sdiv('s_f1', 'n')}, {ROUND})"),
    ]
    for j, (name, p, r, f) in enumerate(avg_rows):
        rows.append(f"SELECT {K + j} AS row_order, {O.q(name)} AS row_name, {p} AS precision, "
                    f"{r} AS recall, {f} AS f1, {sup} AS support FROM c")
    return f"WITH {O.frame_l_sql()}, {O.counts_sql(K)} " + " UNION ALL ".join(rows)


@register("classification_report", _report_sql())
def q_classification_report(spark, sf):
    return rounded_samples(ev.classification_report(B.frame_l(spark, sf), 0.5, "gt"))


@register("weighted_sample_average",
          f"SELECT * FROM ({_report_sql()}) WHERE row_order >= {K}")
def q_weighted_sample_average(spark, sf):
    return rounded_samples(ev.averages(B.frame_l(spark, sf), 0.5, "gt"))


# --- E12-E19 ---------------------------------------------------------------------

from ..operators import analysis as an  # noqa: E402

TS = list(an.DEFAULT_THRESHOLDS)
L_NAME_ARRAY = "[" + ", ".join(O.q(n) for n in L_NAMES) + "]"


@register("threshold_sweep",
          f"WITH {O.frame_l_sql()}, {O.sweep_sql(K, TS)} SELECT * FROM sw")
def q_threshold_sweep(spark, sf):
    return an.threshold_sweep(B.frame_l(spark, sf), TS, "gt")


@register("best_threshold",
          f"WITH {O.frame_l_sql()}, {O.sweep_sql(K, TS)} "
          "SELECT t_idx, threshold, macro_f1 FROM sw ORDER BY macro_f1 DESC, t_idx ASC LIMIT 1")
def q_best_threshold(spark, sf):
    return an.best_threshold(an.threshold_sweep(B.frame_l(spark, sf), TS, "gt"))


def _per_label_report_sql() -> str:
    metrics = _labels_union(O.label_metric_exprs, ev.PER_LABEL_COLUMNS)
    dic = ", ".join(f"({i}, {O.q(B.L_EN[n])}, {O.q(B.L_DESCRIPTIONS[n])})" for i, n in enumerate(L_NAMES))
    return (f"WITH {O.frame_l_sql()}, {O.counts_sql(K)}, {O.auc_sql(K)}, m AS ({metrics}), "
            f"dic AS (SELECT * FROM (VALUES {dic}) AS t(label_idx, label_en, description)) "
            "SELECT m.*, coalesce(a.auc, 0.5::DOUBLE) AS auc, dic.label_en, dic.description, "
            "row_number() OVER (ORDER BY m.f1 DESC, m.label_idx) AS rank "
            "FROM m JOIN auc a USING (label_idx) JOIN dic USING (label_idx)")


@register("per_label_report", _per_label_report_sql())
def q_per_label_report(spark, sf):
    return an.per_label_report(B.frame_l(spark, sf), 0.5, "gt")


def _distribution_sql(truth: bool) -> str:
    bits = [f"y{i}" if truth else f"CAST({O.pred(i, 0.5)} AS INTEGER)" for i in range(K)]
    card = O.fsum(bits)
    cnts = ", ".join(f"CAST(sum({b}) AS BIGINT) AS c_{i}" for i, b in enumerate(bits))
    head = (f"WITH {O.frame_l_sql()}, s AS (SELECT CAST(count(*) AS BIGINT) AS n, sum({card}) AS card_sum, "
            f"max({card}) AS card_max, CAST(count_if({card} = 0) AS BIGINT) AS none, "
            f"CAST(count_if({card} > 1) AS BIGINT) AS several, {cnts} FROM l) ")
    rows = " UNION ALL ".join(
        f"SELECT {i} AS label_idx, {O.q(n)} AS label, c_{i} AS predicted_count, n AS total_samples, "
        f"{O.sdiv('card_sum', 'n')} AS avg_labels_per_sample, CAST(card_max AS BIGINT) AS max_labels_per_sample, "
        "none AS samples_with_no_labels, several AS samples_with_multiple_labels FROM s"
        for i, n in enumerate(L_NAMES))
    return head + rows


@register("prediction_distribution", _distribution_sql(False))
def q_prediction_distribution(spark, sf):
    return an.prediction_distribution(B.frame_l(spark, sf), 0.5, "gt")


def _combinations_sql(truth: bool, top: int = 10) -> str:
    bits = [f"y{i}" if truth else f"CAST({O.pred(i, 0.5)} AS INTEGER)" for i in range(K)]
    vec = "concat_ws(',', " + ", ".join(f"CAST({b} AS VARCHAR)" for b in bits) + ")"
    names = O.names_of(L_NAMES, [f"CAST(string_split(vector, ',')[{i + 1}] AS INTEGER)" for i in range(K)],
                       "clean")
    return (f"WITH {O.frame_l_sql()}, g AS (SELECT {vec} AS vector, CAST(count(*) AS BIGINT) AS count "
            "FROM l GROUP BY 1), tot AS (SELECT CAST(sum(count) AS BIGINT) AS n FROM g), "
            "r AS (SELECT row_number() OVER (ORDER BY count DESC, vector DESC) AS rank, vector, count FROM g) "
            f"SELECT rank, {names} AS labels, vector, count, CAST(count AS DOUBLE) / CAST(n AS DOUBLE) * 100.0::DOUBLE "
            f"AS percentage FROM r CROSS JOIN tot WHERE rank <= {top}")


@register("top_label_combinations", _combinations_sql(False))
def q_top_label_combinations(spark, sf):
    return an.label_combinations(B.frame_l(spark, sf), 0.5, "gt", 10)


def _hard_sql(n: int = 20) -> str:
    conf = f"({O.fsum([f'abs(p{i} - 0.5::DOUBLE)' for i in range(K)])} / {O.d(K)})"
    correct = " AND ".join(f"(CAST({O.pred(i, 0.5)} AS INTEGER) = y{i})" for i in range(K))
    keys = ", ".join(B.L_KEYS)
    order = "hardness DESC, " + ", ".join(f"{c} DESC" for c in B.L_KEYS)
    true_names = O.names_of(L_NAMES, [f"y{i}" for i in range(K)], "clean")
    pred_names = O.names_of(L_NAMES, [f"CAST({O.pred(i, 0.5)} AS INTEGER)" for i in range(K)], "clean")
    probs = ", ".join(f"p{i} AS prob_{i}" for i in range(K))
    return (f"WITH {O.frame_l_sql()}, hx AS (SELECT *, {conf} AS confidence, CAST({correct} AS INTEGER) AS is_correct "
            "FROM l), hy AS (SELECT *, round((1.0::DOUBLE - confidence) * 0.5::DOUBLE + CASE WHEN is_correct = 1 "
            "THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END, 12) AS hardness FROM hx) "
            f"SELECT row_number() OVER (ORDER BY {order}) AS rank, {keys}, {true_names} AS true_labels, "
            f"{pred_names} AS predicted_labels, round(confidence, 12) AS confidence, is_correct, hardness, {probs} "
            f"FROM hy ORDER BY {order} LIMIT {n}")


@register("hard_examples", _hard_sql())
def q_hard_examples(spark, sf):
    return an.hard_examples(B.frame_l(spark, sf), 20)


@register("score_histogram",
          f"WITH {O.frame_l_sql()}, {O.hist_sql(K, 50)} SELECT label_idx, "
          f"{L_NAME_ARRAY}[label_idx + 1] AS label, bin, bin_lo, bin_hi, count FROM hist")
def q_score_histogram(spark, sf):
    return an.score_histogram(B.frame_l(spark, sf), 50)


# --- C1-C7, B1-B12 ------------------------------------------------------------------

from ..operators import corpus as cp  # noqa: E402
from ..operators import runs as rn  # noqa: E402
from ..operators import scoring as sc  # noqa: E402
from ..operators.frame import from_wide  # noqa: E402

D_NAMES = list(B.D_LABELS)
U_NAMES = list(B.U_LABELS)
SPLIT_SQL = "CASE WHEN {k} % 5 = 0 THEN 'valid' ELSE 'train' END"
D_SQL = ("d AS (SELECT doc_id, " + SPLIT_SQL.format(k="doc_id") + " AS split, text, "
         "CAST(quality AS INTEGER) AS quality, CAST(toxic AS INTEGER) AS toxic "
         "FROM documents JOIN labels USING (doc_id))")
U_SQL = ("u AS (SELECT user_id, CAST(ts AS DATE) AS day, " + SPLIT_SQL.format(k="user_id") + " AS split, "
         + ", ".join(f"max(CAST(event_type = {O.q(n)} AS INTEGER)) AS {n}" for n in U_NAMES)
         + " FROM events GROUP BY user_id, CAST(ts AS DATE))")


def _stats_sql(src: str, names: list) -> str:
    card = O.fsum([f"{n}" for n in names])
    cnts = ", ".join(f"CAST(sum({n}) AS BIGINT) AS c_{i}" for i, n in enumerate(names))
    return (f"st AS (SELECT CASE WHEN grouping(split) = 1 THEN 'all' ELSE split END AS split, "
            f"CAST(count(*) AS BIGINT) AS n, sum({card}) AS card_sum, max({card}) AS card_max, "
            f"CAST(count_if({card} = 0) AS BIGINT) AS none, CAST(count_if({card} > 1) AS BIGINT) AS several, "
            f"{cnts} FROM {src} GROUP BY ROLLUP (split))")


SPLIT_COLS_SQL = ("split, n AS total_samples, " + O.sdiv("card_sum", "n") + " AS avg_labels_per_sample, "
                  "CAST(card_max AS BIGINT) AS max_labels_per_sample, none AS samples_with_no_labels, "
                  "several AS samples_with_multiple_labels")


def _label_rows_sql(names: list, with_split_cols: bool) -> str:
    head = SPLIT_COLS_SQL if with_split_cols else "split"
    return " UNION ALL ".join(
        f"SELECT {head}, {i} AS label_idx, {O.q(n)} AS label, c_{i} AS count, "
        f"{O.sdiv(f'c_{i}', 'n')} * 100.0::DOUBLE AS percentage FROM st"
        for i, n in enumerate(names))


@register("label_distribution", f"WITH {D_SQL}, {_stats_sql('d', D_NAMES)} {_label_rows_sql(D_NAMES, False)}")
def q_label_distribution(spark, sf):
    return cp.label_distribution(B.frame_d(spark, sf), B.d_dictionary(), "split")


@register("cardinality_stats", f"WITH {U_SQL}, {_stats_sql('u', U_NAMES)} SELECT {SPLIT_COLS_SQL} FROM st")
def q_cardinality_stats(spark, sf):
    return cp.cardinality_stats(B.frame_u(spark, sf), B.u_dictionary(), "split")


@register("dataset_statistics", f"WITH {D_SQL}, {_stats_sql('d', D_NAMES)} {_label_rows_sql(D_NAMES, True)}")
def q_dataset_statistics(spark, sf):
    return cp.dataset_statistics(B.frame_d(spark, sf), B.d_dictionary(), "split")


@register("events_dataset_statistics",
          f"WITH {U_SQL}, {_stats_sql('u', U_NAMES)} {_label_rows_sql(U_NAMES, True)}")
def q_events_dataset_statistics(spark, sf):
    return cp.dataset_statistics(B.frame_u(spark, sf), B.u_dictionary(), "split")


def _weights_sql(method: str, names: list, src: str) -> str:
    k = len(names)
    head = (f"cw AS (SELECT CAST(count(*) AS BIGINT) AS n, "
            + ", ".join(f"CAST(coalesce(sum({n}), 0) AS BIGINT) AS c_{i}" for i, n in enumerate(names))
            + f" FROM {src})")
    rows = []
    raw = [f"(1.0::DOUBLE / ({O.sdiv(f'c_{i}', 'n')} + {O.d(cp.INVERSE_FREQUENCY_EPS)}))" for i in range(k)]
    for i, n in enumerate(names):
        pos, neg = f"c_{i}", f"(n - c_{i})"
        if method == "neg_pos":
            qv, rv = f"(({neg} * 1000) // {pos})", f"(({neg} * 1000) % {pos})"
            w = (f"CASE WHEN {pos} = 0 THEN 1.0::DOUBLE ELSE CAST(CASE WHEN 2 * {rv} > {pos} THEN {qv} + 1 "
                 f"WHEN 2 * {rv} = {pos} AND {qv} % 2 = 1 THEN {qv} + 1 ELSE {qv} END AS DOUBLE) / 1000.0::DOUBLE END")
        elif method == "balanced":
            w = f"CASE WHEN {pos} = 0 THEN 1.0::DOUBLE ELSE CAST({neg} AS DOUBLE) / CAST({pos} AS DOUBLE) END"
        elif method == "inverse_frequency":
            w = f"{raw[i]} / {O.fsum(raw)} * {O.d(k)}"
        else:
            w = "1.0::DOUBLE"
        cond = f" WHERE {pos} > 0" if method == "neg_pos" else ""
        rows.append(f"SELECT {i} AS label_idx, {O.q(n)} AS label, {pos} AS n_pos, CAST({neg} AS BIGINT) AS n_neg, "
                    f"{w} AS pos_weight FROM cw{cond}")
    return head + " " + " UNION ALL ".join(rows)


for _m in ("neg_pos", "balanced", "inverse_frequency", "none"):
    def _mk(method):
        def fn(spark, sf):
            # parity with the published weights: every row counts, empty labels drop
            return cp.class_weights(B.frame_u(spark, sf), B.u_dictionary(), method, splits=None, drop_empty=True)
        return fn
    register(f"class_weights_{_m}", f"WITH {U_SQL}, {_weights_sql(_m, U_NAMES, 'u')}")(_mk(_m))


@register("truth_label_combinations",
          f"WITH {U_SQL}, g AS (SELECT concat_ws(',', " + ", ".join(f"CAST({n} AS VARCHAR)" for n in U_NAMES)
          + ") AS vector, CAST(count(*) AS BIGINT) AS count FROM u GROUP BY 1), "
          "tot AS (SELECT CAST(sum(count) AS BIGINT) AS n FROM g), "
          "r AS (SELECT row_number() OVER (ORDER BY count DESC, vector DESC) AS rank, vector, count FROM g) "
          "SELECT rank, " + O.names_of(U_NAMES, [f"CAST(string_split(vector, ',')[{i + 1}] AS INTEGER)"
                                                 for i in range(len(U_NAMES))], "clean")
          + " AS labels, vector, count, CAST(count AS DOUBLE) / CAST(n AS DOUBLE) * 100.0::DOUBLE AS percentage "
          "FROM r CROSS JOIN tot WHERE rank <= 10")
def q_truth_label_combinations(spark, sf):
    u = B.frame_u(spark, sf)
    ef = from_wide(u, ["user_id", "day"], B.u_dictionary(), truth_cols=U_NAMES)
    return an.label_combinations(ef, top=10, truth=True)


def _flatten_sql() -> str:
    ov = O.overall_exprs(K)
    names = list(ov) + ["macro_auc"]
    auc_fill = O.fsum([f"(SELECT coalesce(auc, 0.5::DOUBLE) FROM auc WHERE label_idx = {i})" for i in range(K)])
    cols = ", ".join(f"{e} AS {n}" for n, e in ov.items())
    rows = [f"SELECT 'eval_overall_{n}' AS name, CAST({n} AS DOUBLE) AS value FROM o" for n in names]
    rows += [f"SELECT 'eval_avg_{m}' AS name, round({O.macro(m, K)}, 9) AS value FROM c"
             for m in ("precision", "recall", "f1")]
    return (f"WITH {O.frame_l_sql()}, {O.counts_sql(K)}, {O.auc_sql(K)}, "
            f"o AS (SELECT {cols}, {auc_fill} / {O.d(K)} AS macro_auc FROM c) " + " UNION ALL ".join(rows))


@register("flatten_metrics", _flatten_sql())
def q_flatten_metrics(spark, sf):
    ef = B.frame_l(spark, sf)
    flat = cp.flatten_metrics(ev.overall_metrics(ef), prefix="eval_")
    return flat.withColumn("value", F.when(F.col("name").startswith("eval_avg_"), F.round("value", ROUND))
                           .otherwise(F.col("value")))


@register("normalize_labels",
          "SELECT doc_id, text, CAST(quality AS INTEGER) AS quality, CAST(toxic AS INTEGER) AS toxic, "
          "0 AS spam FROM documents JOIN labels USING (doc_id)")
def q_normalize_labels(spark, sf):
    from ..functions.dictionary import make_dictionary
    raw = (spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").alias("body"))
           .join(spark.read.parquet(f"{sf}/labels.parquet")
                 .select("doc_id", "quality", F.col("toxic").alias("is_toxic")), "doc_id"))
    dic = make_dictionary(["quality", "toxic", "spam"], aliases={"toxic": ["is_toxic"]})
    assert cp.detect_labels(raw.withColumn("spam", F.lit(0)), dic)
    return cp.normalize_labels(raw, dic, text_col="body", keep=["doc_id"])


@register("take_prefix",
          f"WITH {D_SQL} (SELECT * FROM d WHERE split = 'train' ORDER BY doc_id LIMIT 100) "
          "UNION ALL (SELECT * FROM d WHERE split = 'valid' ORDER BY doc_id LIMIT 20)")
def q_take_prefix(spark, sf):
    return cp.take_prefix(B.frame_d(spark, sf), 100, "doc_id")


@register("shuffle_rows",
          f"WITH {D_SQL} SELECT doc_id, split, CAST(('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), "
          "'42', '1')), 1, 8)) AS BIGINT) AS shuffle_key FROM d")
def q_shuffle_rows(spark, sf):
    d = B.frame_d(spark, sf).select("doc_id", "split")
    return cp.shuffle_rows(d, "doc_id", seed=42, epoch=1, portable=True)


@register("validate_requests",
          "WITH r AS (SELECT doc_id, text, CAST(doc_id % 12 AS DOUBLE) / 10.0::DOUBLE AS threshold FROM documents) "
          "SELECT doc_id, threshold, CAST(length(text) AS INTEGER) AS n_chars, CASE WHEN text IS NULL THEN 'text_missing' "
          "WHEN length(text) < 1 THEN 'text_too_short' WHEN length(text) > 4000 THEN 'text_too_long' "
          "WHEN regexp_matches(text, '^\\s*$') THEN 'text_blank' "
          "WHEN threshold < 0.0::DOUBLE OR threshold > 1.0::DOUBLE THEN 'threshold_out_of_range' END AS reason FROM r")
def q_validate_requests(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", "text", ((F.col("doc_id") % 12).cast("double") / F.lit(10.0)).alias("threshold"))
    v = cp.validate_requests(docs)
    return v.select("doc_id", "threshold", F.length("text").alias("n_chars"), "reason")


# --- D3, D4, D11: scoring on frame V --------------------------------------------------

V_NAMES = [f"class_{i}" for i in range(10)]
SCORE_ROUND = 6
CENT_SQL = ("e AS (SELECT vec_id, label, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1)) AS dim "
            "FROM embeddings), cent AS (SELECT label AS k, dim, avg(CAST(x AS DOUBLE)) AS w FROM e GROUP BY label, dim), "
            f"bias AS (SELECT k, -{B.CENTROID_SCALE * 0.5!r}::DOUBLE * sum(w * w) AS b FROM cent GROUP BY k), "
            f"lg AS (SELECT e.vec_id, c.k AS label_idx, sum(CAST(e.x AS DOUBLE) * ({B.CENTROID_SCALE!r}::DOUBLE * c.w)) "
            "AS dotp FROM e JOIN cent c ON e.dim = c.dim GROUP BY e.vec_id, c.k), "
            "sv AS (SELECT lg.vec_id, lg.label_idx, lg.dotp + bias.b AS z, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(lg.dotp + bias.b))) "
            "AS p FROM lg JOIN bias ON bias.k = lg.label_idx)")


def _scored_v(spark, sf):
    weights, bias = B.centroid_head(spark, sf)
    v = B.frame_v(spark, sf)
    z = sc.linear_head(v, weights, bias, "features", "logit")
    return sc.probabilities(z, 10, "logit", "score")


@register("linear_head_scores",
          f"WITH {CENT_SQL} SELECT vec_id, label_idx, round(z, {SCORE_ROUND}) AS logit, "
          f"round(p, {SCORE_ROUND}) AS probability FROM sv")
def q_linear_head_scores(spark, sf):
    s = _scored_v(spark, sf)
    cells = F.array(*[F.struct(F.lit(i).alias("label_idx"), F.col("logit")[i].alias("z"),
                               F.col("score")[i].alias("p")) for i in range(10)])
    return s.select("vec_id", F.inline(cells)).select(
        "vec_id", "label_idx", F.round("z", SCORE_ROUND).alias("logit"),
        F.round("p", SCORE_ROUND).alias("probability"))


@register("score_batch",
          f"WITH {CENT_SQL}, nm AS (SELECT * FROM (VALUES "
          + ", ".join(f"({i}, {O.q(n)})" for i, n in enumerate(V_NAMES))
          + ") AS t(label_idx, name)) SELECT sv.vec_id, arg_max(nm.name, sv.p) AS top_label, "
          f"round(max(sv.p), {SCORE_ROUND}) AS top_probability, coalesce(string_agg(nm.name, ',' ORDER BY sv.label_idx) "
          "FILTER (WHERE sv.p >= 0.5::DOUBLE), '') AS predicted, CAST(count_if(sv.p >= 0.5::DOUBLE) AS INTEGER) AS n_predicted "
          "FROM sv JOIN nm USING (label_idx) GROUP BY sv.vec_id")
def q_score_batch(spark, sf):
    s = sc.score_batch(_scored_v(spark, sf), V_NAMES, 0.5, "ge")
    picked = F.filter("labels", lambda x: x["predicted"])
    return s.select("vec_id", F.col("top.name").alias("top_label"),
                    F.round("top.probability", SCORE_ROUND).alias("top_probability"),
                    F.array_join(F.transform(picked, lambda x: x["name"]), ",").alias("predicted"),
                    F.size(picked).alias("n_predicted"))


# --- D5-D8, E11: losses on frame L logits ---------------------------------------------

SUM_ROUND = 4  # digits of compared loss sums (up to about 1e6 at sf0.1)


def _loss_sql(kinds, z: str = "(p{i} - 0.5::DOUBLE) * 6.0::DOUBLE", scale: float = 1.0) -> str:
    k = K
    cells = " UNION ALL ".join(
        f"SELECT {i} AS label_idx, y{i} AS y, {z.format(i=i)} AS z FROM l" for i in range(k))
    wrows = []
    for i in range(k):
        pos, neg = f"c_{i}", f"(n - c_{i})"
        qv, rv = f"(({neg} * 1000) // {pos})", f"(({neg} * 1000) % {pos})"
        w = (f"CASE WHEN {pos} = 0 THEN 1.0::DOUBLE ELSE CAST(CASE WHEN 2 * {rv} > {pos} THEN {qv} + 1 "
             f"WHEN 2 * {rv} = {pos} AND {qv} % 2 = 1 THEN {qv} + 1 ELSE {qv} END AS DOUBLE) / 1000.0::DOUBLE END")
        wrows.append(f"SELECT {i} AS label_idx, {w} AS pw FROM cwl")
    # ln(1 + e) by its series where e is tiny, since DuckDB has no log1p
    e = "exp(-abs(z))"
    soft = (f"(CASE WHEN {e} < 0.00001::DOUBLE THEN {e} - {e} * {e} / 2.0::DOUBLE + {e} * {e} * {e} / 3.0::DOUBLE "
            f"ELSE ln(1.0::DOUBLE + {e}) END)")
    bce = f"((1.0::DOUBLE - y) * z + ({soft} + greatest(-z, 0.0::DOUBLE)))"
    lw = "((pw - 1.0::DOUBLE) * y + 1.0::DOUBLE)"
    wbce = f"((1.0::DOUBLE - y) * z + {lw} * ({soft} + greatest(-z, 0.0::DOUBLE)))"
    pr = "(1.0::DOUBLE / (1.0::DOUBLE + exp(-z)))"
    pt = f"({pr} * y + (1.0::DOUBLE - {pr}) * (1.0::DOUBLE - y))"
    focal = f"(1.0::DOUBLE * pow(1.0::DOUBLE - {pt}, 2.0::DOUBLE) * {bce})"
    exprs = {"bce": bce, "weighted_bce": wbce, "focal": focal}
    rows = " UNION ALL ".join(
        f"SELECT {O.q(kd)} AS kind, round(s_{kd} * {O.d(scale)} / n, {ROUND}) AS mean, "
        f"round(s_{kd} * {O.d(scale)}, {SUM_ROUND}) AS sum, n FROM agg" for kd in kinds)
    sums = ", ".join(f"sum({exprs[kd]}) AS s_{kd}" for kd in kinds)
    return (f"WITH {O.frame_l_sql()}, cwl AS (SELECT CAST(count(*) AS BIGINT) AS n, "
            + ", ".join(f"CAST(sum(y{i}) AS BIGINT) AS c_{i}" for i in range(k)) + " FROM l), "
            f"w AS ({' UNION ALL '.join(wrows)}), cl AS ({cells}), "
            "cz AS (SELECT cl.label_idx, CAST(cl.y AS DOUBLE) AS y, cl.z, coalesce(w.pw, 1.0::DOUBLE) AS pw "
            "FROM cl LEFT JOIN w USING (label_idx)), "
            f"agg AS (SELECT CAST(count(*) AS BIGINT) AS n, {sums} FROM cz) {rows}")


def _compared(losses: DataFrame, scale: float = 1.0) -> DataFrame:
    return losses.select("kind", F.round(F.col("mean") * scale, ROUND).alias("mean"),
                         F.round(F.col("sum") * scale, SUM_ROUND).alias("sum"), "n")


def _loss_query(kinds):
    def fn(spark, sf):
        ef = B.frame_l_logits(spark, sf)
        wide = ef.df.select(*[F.col("y_true")[i].alias(n) for i, n in enumerate(L_NAMES)])
        pw = cp.class_weights(wide, ef.labels, "neg_pos", splits=None) if "weighted_bce" in kinds else None
        return _compared(sc.loss_summary(ef, kinds, "logit", pw))
    return fn


# a model that is right everywhere by 32 to 33 logits: true mean about 1e-14, compared times 1e14
CONFIDENT = "(2.0::DOUBLE * y{i} - 1.0::DOUBLE) * (32.0::DOUBLE + p{i})"


@register("confident_loss", _loss_sql(["bce"], CONFIDENT, 1e14))
def q_confident_loss(spark, sf):
    ef = B.frame_l(spark, sf)
    z = ", ".join(f"(2.0D * y_true[{i}] - 1.0D) * (32.0D + score[{i}])" for i in range(ef.k))
    return _compared(sc.loss_summary(ef.with_df(ef.df.selectExpr("*", f"array({z}) AS logit")), ["bce"]), 1e14)


register("bce_loss", _loss_sql(["bce"]))(_loss_query(["bce"]))
register("weighted_bce_loss", _loss_sql(["weighted_bce"]))(_loss_query(["weighted_bce"]))
register("focal_loss", _loss_sql(["focal"]))(_loss_query(["focal"]))
register("evaluation_loss", _loss_sql(list(sc.LOSS_KINDS)))(_loss_query(list(sc.LOSS_KINDS)))


# --- F1-F5 and G2 batch: run logs from events ----------------------------------------------

H_SQL = ("h AS (SELECT user_id AS run_id, event_id AS step, ts, CASE event_type "
         + " ".join(f"WHEN {O.q(a)} THEN {O.q(b)}" for a, b in B.RUN_METRICS.items())
         + " END AS metric, value FROM events)")


def _best_sql(metric: str, mode: str) -> str:
    agg = "max" if mode == "max" else "min"
    return (f"WITH {H_SQL}, s AS (SELECT run_id, step, value FROM h WHERE metric = {O.q(metric)}), "
            f"b AS (SELECT run_id, {agg}(value) AS best_value, CAST(count(*) AS BIGINT) AS n_values FROM s GROUP BY run_id), "
            "bs AS (SELECT s.run_id, min(s.step) AS best_step FROM s JOIN b USING (run_id) "
            "WHERE s.value = b.best_value GROUP BY s.run_id), "
            "bp AS (SELECT s.run_id, CAST(count_if(s.step < bs.best_step) AS BIGINT) AS best_position "
            "FROM s JOIN bs USING (run_id) GROUP BY s.run_id) "
            f"SELECT run_id, {O.q(metric)} AS metric, best_value, best_step, best_position, n_values "
            "FROM b JOIN bs USING (run_id) JOIN bp USING (run_id)")


@register("best_metric", _best_sql("eval_f1", "max"))
def q_best_metric(spark, sf):
    return rn.best_metric(B.frame_h(spark, sf, ["eval_f1"]), "eval_f1", "max")


@register("best_checkpoint", _best_sql("eval_loss", "min"))
def q_best_checkpoint(spark, sf):
    return rn.best_checkpoint(B.frame_h(spark, sf, ["eval_loss"]), "eval_loss")


def _early_stop_sql(metric: str, patience: int, delta: float) -> str:
    imp = f"(s.value IS NOT NULL AND (r.best IS NULL OR s.value > r.best + {O.d(delta)}))"
    return (f"WITH RECURSIVE {H_SQL}, s AS (SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY step) - 1 "
            f"AS pos, CASE WHEN NOT isnan(value) THEN value END AS value FROM h WHERE metric = {O.q(metric)}), "
            "r AS (SELECT run_id, pos, value AS best, pos AS best_pos, 0 AS cnt, 0 AS stopped, "
            "CAST(NULL AS BIGINT) AS stop_pos FROM s WHERE pos = 0 UNION ALL "
            f"SELECT s.run_id, s.pos, CASE WHEN {imp} THEN s.value ELSE r.best END, "
            f"CASE WHEN {imp} THEN s.pos ELSE r.best_pos END, CASE WHEN {imp} THEN 0 ELSE r.cnt + 1 END, "
            f"CASE WHEN NOT {imp} AND r.cnt + 1 >= {patience} THEN 1 ELSE 0 END, "
            f"CASE WHEN NOT {imp} AND r.cnt + 1 >= {patience} THEN s.pos END "
            "FROM r JOIN s ON s.run_id = r.run_id AND s.pos = r.pos + 1 WHERE r.stopped = 0), "
            "nst AS (SELECT run_id, CAST(count(*) AS BIGINT) AS n_steps FROM s GROUP BY run_id), "
            "lastr AS (SELECT run_id, max(pos) AS pos FROM r GROUP BY run_id) "
            "SELECT r.run_id, nst.n_steps, CAST(r.stopped AS INTEGER) AS stopped, r.stop_pos AS stop_position, "
            "CAST(r.best_pos AS BIGINT) AS best_position, r.best AS best_value "
            "FROM r JOIN lastr USING (run_id, pos) JOIN nst USING (run_id)")


@register("early_stop", _early_stop_sql("eval_f1", rn.DEFAULT_PATIENCE, rn.DEFAULT_MIN_DELTA))
def q_early_stop(spark, sf):
    return rn.early_stop(B.frame_h(spark, sf, ["eval_f1"]), "eval_f1", rn.DEFAULT_PATIENCE,
                         rn.DEFAULT_MIN_DELTA, "max")


@register("training_curves",
          f"WITH {H_SQL} SELECT run_id, step, "
          + ", ".join((f"max(CASE WHEN metric = {O.q(m)} THEN value END) AS {m}" if m == "macro_auc" else
                       f"coalesce(max(CASE WHEN metric = {O.q(m)} THEN value END), 0.0::DOUBLE) AS {m}")
                      for m in rn.CURVE_METRICS)
          + " FROM h GROUP BY run_id, step")
def q_training_curves(spark, sf):
    return rn.training_curves(B.frame_h(spark, sf))


@register("recent_history",
          "SELECT * FROM (SELECT user_id, event_id, ts, event_type, value, row_number() OVER "
          "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events) WHERE rank <= 10")
def q_recent_history(spark, sf):
    from ..streaming.history import recent_history
    ev_ = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "event_id", "ts", "event_type", "value")
    return recent_history(ev_, "user_id", ["ts", "event_id"], 10)


def _history_clear_sql(n: int = 10) -> str:
    # (user_id, ts) is unique in events, so "after the clear" is ts > clear ts
    c = O.q(B.CLEAR_EVENT)
    return ("WITH c AS (SELECT user_id, max(ts) AS clear_ts FROM events WHERE event_type = " + c
            + " GROUP BY user_id) SELECT * FROM (SELECT e.user_id, e.event_id, e.ts, e.event_type, e.value, "
            "row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts DESC, e.event_id DESC) AS rank "
            "FROM events e LEFT JOIN c USING (user_id) WHERE e.event_type <> " + c
            + f" AND (c.clear_ts IS NULL OR e.ts > c.clear_ts)) WHERE rank <= {n}")


@register("recent_history_clear", _history_clear_sql())
def q_recent_history_clear(spark, sf):
    from ..streaming.history import recent_history
    ev_ = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "event_id", "ts", "event_type", "value")
    return recent_history(ev_, "user_id", ["ts", "event_id"], 10,
                          clear=f"event_type = {O.q(B.CLEAR_EVENT)}")


# --- D1: text length work on documents --------------------------------------------------

from ..operators import features as ft  # noqa: E402


@register("length_profile",
          "WITH t AS (SELECT len(string_split(text, ' ')) AS n FROM documents), a AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, "
          + ", ".join(f"CAST(count_if(n > {L}) AS BIGINT) AS tr_{L}, CAST(sum(greatest({L} - n, 0)) AS BIGINT) AS pad_{L}"
                      for L in ft.PROFILE_LENGTHS) + " FROM t) "
          + " UNION ALL ".join(f"SELECT {L} AS max_length, n_docs, tr_{L} AS n_truncated, CAST(tr_{L} AS DOUBLE) / "
                               f"CAST(n_docs AS DOUBLE) AS share_truncated, CAST(pad_{L} AS DOUBLE) / (CAST(n_docs AS DOUBLE) "
                               f"* {O.d(L)}) AS avg_padding_share FROM a" for L in ft.PROFILE_LENGTHS))
def q_length_profile(spark, sf):
    return ft.length_profile(spark.read.parquet(f"{sf}/documents.parquet").select("text"))


@register("encode_corpus",
          "WITH t AS (SELECT doc_id, string_split(text, ' ') AS tok FROM documents) SELECT doc_id, "
          "CAST(len(tok) AS INTEGER) AS n_tokens, CAST(least(len(tok), 512) AS INTEGER) AS mask_sum, "
          "CAST(greatest(512 - len(tok), 0) AS INTEGER) AS n_pad, "
          "CASE WHEN len(tok) >= 512 THEN tok[512] ELSE '[PAD]' END AS last_input_token FROM t")
def q_encode_corpus(spark, sf):
    enc = ft.encode_corpus(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), 512)
    return enc.select("doc_id", "n_tokens",
                      F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
                      F.size(F.filter("attention_mask", lambda x: x == 0)).alias("n_pad"),
                      F.element_at("input_tokens", -1).alias("last_input_token"))


# --- D2, D9, D10: fitting (rows-only checks) -----------------------------------------------

from ..operators import fit as fit_ops  # noqa: E402


TFIDF_SQL = (f"WITH {D_SQL}, tok AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+')) "
             "AS t FROM d), cell AS (SELECT doc_id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % 262144 AS bucket, "
             "count(*) AS tf FROM tok WHERE t <> '' GROUP BY 1, 2), idf AS (SELECT bucket, "
             "ln((CAST((SELECT count(*) FROM d) AS DOUBLE) + 1.0::DOUBLE) / (CAST(count(*) AS DOUBLE) + 1.0::DOUBLE)) AS idf "
             "FROM cell GROUP BY 1) SELECT doc_id, count(*) AS n_nonzero, CAST(sum(tf) AS BIGINT) AS n_tokens, "
             "round(sum(tf * idf), 6) AS tfidf_sum FROM cell JOIN idf USING (bucket) GROUP BY 1")


@register("text_features", TFIDF_SQL)
def q_text_features(spark, sf):
    cells = ft.tfidf_cells(B.frame_d(spark, sf).select("doc_id", "text"), "doc_id")
    return cells.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_nonzero"), F.sum("tf").alias("n_tokens"),
                                       F.round(F.sum("tfidf"), 6).alias("tfidf_sum"))


V_LABEL_ROWS = " UNION ALL ".join(f"SELECT {i} AS label_idx, 'class_{i}' AS label" for i in range(10))


@register("fit_binary_relevance",
          f"SELECT l.label_idx, l.label, CAST((SELECT count(*) FROM embeddings) - count(e.label) AS DOUBLE) "
          f"/ CAST(count(e.label) AS DOUBLE) AS pos_weight, true AS at_optimum FROM ({V_LABEL_ROWS}) l "
          "LEFT JOIN embeddings e ON e.label = l.label_idx GROUP BY 1, 2")
def q_fit_binary_relevance(spark, sf):
    """Weighted logistic regressions of the vector classes; each fit must stand at the
    optimum of its regularised objective (gradient within 1e-5 of zero)."""
    from pyspark.ml.functions import array_to_vector
    v, dic = B.frame_v(spark, sf), B.v_dictionary()
    wide = v.select(*[F.col("y_true")[i].alias(n) for i, n in enumerate(V_NAMES)])
    # K weights (bounded by K) reach the driver as the model's parameters do
    weights = {r["label"]: r["pos_weight"] for r in cp.class_weights(wide, dic, "balanced", splits=None).collect()}
    models, summary = fit_ops.fit_binary_relevance(
        v.select(array_to_vector("features").alias("features"), "y_true"), V_NAMES, pos_weights=weights)
    gaps = fit_ops.optimality_gap(v, models, V_NAMES, weights)
    good = F.array(*[F.lit(g < 1e-5) for g in gaps])
    return summary.select("label_idx", "label", "pos_weight", F.get(good, F.col("label_idx")).alias("at_optimum"))


FOCAL_LR, FOCAL_EPOCHS, FIT_ROUND = 2.0, 3, 9


def _head_fit_sql(kind: str = "focal", k: int = 10, lr: float = FOCAL_LR, epochs: int = FOCAL_EPOCHS,
                  weights_out: bool = False) -> str:
    """Full-batch gradient descent of the K heads under focal (alpha 1, gamma
    2) or weighted BCE loss (positives weigh negatives / positives of their
    class) from zero weights, written out epoch by epoch; the loss of each
    epoch is taken before its update, as in ``fit_linear_head``.  Returns the
    losses, or the rounded weights after the last update."""
    one = O.d(1.0)

    def cell(z: str) -> dict:
        p = f"({one} / ({one} + exp(-{z})))"
        pt = f"({p} * y + ({one} - {p}) * ({one} - y))"
        bce = f"(({one} - y) * {z} + ln({one} + exp(-abs({z}))) + greatest(-{z}, {O.d(0.0)}))"
        if kind == "weighted_bce":
            lw = f"((pw - {one}) * y + {one})"
            soft = f"(ln({one} + exp(-abs({z}))) + greatest(-{z}, {O.d(0.0)}))"
            return {"loss": f"(({one} - y) * {z} + {lw} * {soft})", "grad": f"(({one} - y) - {lw} * ({one} - {p}))"}
        mod = f"pow({one} - {pt}, {O.d(2.0)})"
        dmod = f"({O.d(2.0)} * ({one} - {pt}) * (-({O.d(2.0)} * y - {one}) * {p} * ({one} - {p})))"
        return {"loss": f"({mod} * {bce})", "grad": f"({dmod} * {bce} + {mod} * ({p} - y))"}

    ctes = ["e AS (SELECT vec_id, label, unnest(embedding) AS x, "
            "unnest(generate_series(0, len(embedding) - 1)) AS dim FROM embeddings)",
            "v AS (SELECT DISTINCT vec_id, label FROM e)",
            f"cells AS (SELECT v.vec_id, kk.k, CAST(v.label = kk.k AS DOUBLE) AS y, "
            f"coalesce(cnt.pw, 1.0::DOUBLE) AS pw FROM v "
            f"CROSS JOIN (SELECT unnest(generate_series(0, {k - 1})) AS k) kk LEFT JOIN (SELECT label, "
            "CAST((SELECT count(*) FROM v) - count(*) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS pw "
            "FROM v GROUP BY label) cnt ON cnt.label = kk.k)",
            f"nc AS (SELECT CAST(count(*) AS DOUBLE) AS cells FROM cells)",
            "w0 AS (SELECT kk.k, d.dim, 0.0::DOUBLE AS w FROM (SELECT DISTINCT k FROM cells) kk "
            "CROSS JOIN (SELECT DISTINCT dim FROM e) d)",
            "b0 AS (SELECT DISTINCT k, 0.0::DOUBLE AS b FROM cells)"]
    for t in range(epochs):
        ctes.append(f"z{t} AS (SELECT c.vec_id, c.k, c.y, c.pw, sum(e.x * w.w) + max(b.b) AS z FROM cells c "
                    f"JOIN e ON e.vec_id = c.vec_id JOIN w{t} w ON w.k = c.k AND w.dim = e.dim "
                    f"JOIN b{t} b ON b.k = c.k GROUP BY c.vec_id, c.k, c.y, c.pw)")
        f = cell("z")
        ctes.append(f"g{t} AS (SELECT vec_id, k, {f['loss']} AS loss, {f['grad']} AS g FROM z{t})")
        ctes.append(f"h{t} AS (SELECT {t} AS epoch, sum(loss) / (SELECT cells FROM nc) AS mean_loss FROM g{t})")
        if t + 1 < epochs or weights_out:
            ctes.append(f"w{t + 1} AS (SELECT w.k, w.dim, w.w - {O.d(lr)} * sum(g.g * e.x) / (SELECT cells FROM nc) "
                        f"AS w FROM w{t} w JOIN g{t} g ON g.k = w.k JOIN e ON e.vec_id = g.vec_id "
                        f"AND e.dim = w.dim GROUP BY w.k, w.dim, w.w)")
            ctes.append(f"b{t + 1} AS (SELECT b.k, b.b - {O.d(lr)} * sum(g.g) / (SELECT cells FROM nc) AS b "
                        f"FROM b{t} b JOIN g{t} g ON g.k = b.k GROUP BY b.k, b.b)")
    if weights_out:
        return (f"WITH {', '.join(ctes)} SELECT CAST(k AS INTEGER) AS label_idx, CAST(dim AS INTEGER) AS dim, "
                f"round(w, {FIT_ROUND}) AS weight FROM w{epochs}")
    hist = " UNION ALL ".join(f"SELECT * FROM h{t}" for t in range(epochs))
    return (f"WITH {', '.join(ctes)} SELECT CAST(epoch AS INTEGER) AS epoch, "
            f"round(mean_loss, {FIT_ROUND}) AS mean_loss FROM ({hist})")


@register("fit_linear_head_focal", _head_fit_sql())
def q_fit_linear_head_focal(spark, sf):
    v = B.frame_v(spark, sf)
    _, _, hist = fit_ops.fit_linear_head(v, 10, B.feature_dim(v), "focal", epochs=FOCAL_EPOCHS, lr=FOCAL_LR)
    # K x d parameters and one loss per epoch reach the driver, as a fit's do
    return spark.createDataFrame([(e, round(m, FIT_ROUND)) for e, m in hist], "epoch int, mean_loss double")


@register("fit_linear_head_weighted_bce", _head_fit_sql("weighted_bce", weights_out=True))
def q_fit_linear_head_weighted_bce(spark, sf):
    """The class weights of the vectors feed the weighted fit; its weights are compared."""
    v = B.frame_v(spark, sf)
    wide = v.select(*[F.col("y_true")[i].alias(n) for i, n in enumerate(V_NAMES)])
    w = {r["label_idx"]: r["pos_weight"] for r in
         cp.class_weights(wide, B.v_dictionary(), "balanced", splits=None).collect()}
    head, _, _ = fit_ops.fit_linear_head(v, 10, B.feature_dim(v), "weighted_bce", epochs=FOCAL_EPOCHS, lr=FOCAL_LR,
                                         pos_weight=[w[i] for i in range(10)])
    return spark.createDataFrame([(k, d, round(float(x), FIT_ROUND)) for k, row in enumerate(head)
                                  for d, x in enumerate(row)], "label_idx int, dim int, weight double")


# --- A1-A9: sources and sinks (round trips through the shared folder) ----------------------

from ..session import scratch_path, stream_table  # noqa: E402
from ..sources import corpus_io as io  # noqa: E402
from ..sources import reports as rp  # noqa: E402

D_SELECT_SQL = f"WITH {D_SQL} SELECT doc_id, text, quality, toxic, split FROM d"


@register("csv_round_trip", D_SELECT_SQL)
def q_csv_round_trip(spark, sf):
    from pyspark.sql import types as T
    path = scratch_path(spark, "labeled-csv")
    io.write_labeled(B.frame_d(spark, sf), path, "csv")
    back = io.read_labeled_csv(spark, path, B.d_dictionary(), extra=[("doc_id", T.LongType())])
    return back.select("doc_id", "text", "quality", "toxic", "split")


@register("parquet_round_trip", D_SELECT_SQL)
def q_parquet_round_trip(spark, sf):
    path = scratch_path(spark, "labeled-parquet")
    io.write_labeled(B.frame_d(spark, sf), path, "parquet")
    return io.read_raw(spark, path, "parquet").select("doc_id", "text", "quality", "toxic", "split")


@register("label_list_round_trip",
          f"WITH {D_SQL} SELECT doc_id, split, text, CAST(quality AS VARCHAR) || ',' || CAST(toxic AS VARCHAR) "
          "AS labels FROM d")
def q_label_list_round_trip(spark, sf):
    from pyspark.sql import types as T
    path = scratch_path(spark, "label-list-csv")
    io.write_label_list(B.frame_d(spark, sf), B.d_dictionary(), path, "csv", keep=("doc_id", "text"))
    back = io.read_label_list_csv(spark, path, extra=[("doc_id", T.LongType())])
    return back.select("doc_id", "split", "text", F.array_join("labels", ",").alias("labels"))


@register("metadata_round_trip", f"WITH {U_SQL}, {_weights_sql('neg_pos', U_NAMES, 'u')}")
def q_metadata_round_trip(spark, sf):
    path = scratch_path(spark, "metadata")
    dic = B.u_dictionary()
    u = B.frame_u(spark, sf)
    io.write_metadata(path, weights=cp.class_weights(u, dic, "neg_pos", splits=None, drop_empty=True), labels=dic,
                      statistics=cp.dataset_statistics(u, dic), spark=spark)
    assert io.read_label_info(spark, path).names == dic.names
    return io.read_class_weights(spark, path)


@register("detailed_predictions",
          f"WITH {O.frame_l_sql()} SELECT {', '.join(B.L_KEYS)}, "
          + ", ".join(f"p{i} AS {n}_prob" for i, n in enumerate(L_NAMES)) + ", "
          + ", ".join(f"CAST({O.pred(i, 0.5)} AS INTEGER) AS {n}_pred" for i, n in enumerate(L_NAMES)) + ", "
          + ", ".join(f"CAST(y{i} AS DOUBLE) AS {n}_true" for i, n in enumerate(L_NAMES)) + " FROM l")
def q_detailed_predictions(spark, sf):
    return rp.detailed_predictions(B.frame_l(spark, sf), 0.5, "gt")


# section of the written report -> (checked query with the same rows, key, metrics)
REPORT = {
    "overall": ("overall_metrics", "'all'", ("exact_match_accuracy", "hamming_loss", "macro_f1", "micro_f1", "macro_auc")),
    "per_label": ("per_label_report", "label", ("precision", "recall", "f1", "specificity", "auc", "support", "rank")),
    "confusion": ("confusion_matrix", "label", ("tn", "fp", "fn", "tp")),
    "classification_report": ("classification_report", "row_name", ("precision", "recall", "f1", "support")),
    "threshold_sweep": ("threshold_sweep", "CAST(t_idx AS {s})", ("threshold", "exact_match_accuracy", "macro_f1")),
    "best_threshold": ("best_threshold", "'best'", ("threshold", "macro_f1")),
    "prediction_distribution": ("prediction_distribution", "label", ("predicted_count", "avg_labels_per_sample")),
    "top_label_combinations": ("top_label_combinations", "vector", ("rank", "count", "percentage")),
    "hard_examples": ("hard_examples", "CAST(rank AS {s})", ("confidence", "is_correct", "hardness")),
    "score_histogram": ("score_histogram", "label || ':' || CAST(bin AS {s})", ("bin_lo", "bin_hi", "count")),
}


def _report_content_sql() -> str:
    parts = []
    for section, (query, key, metrics) in REPORT.items():
        for m in metrics:
            value = f"round(CAST({m} AS DOUBLE), {ROUND})"
            parts.append(f"SELECT '{section}' AS section, {key.format(s='VARCHAR')} AS key, '{m}' AS metric, "
                         f"{value} AS value FROM ({ORACLE[query]})")
    return " UNION ALL ".join(parts)


@register("evaluation_report", _report_content_sql())
def q_evaluation_report(spark, sf):
    # the written sections read back, as (section, key, metric, value)
    path = scratch_path(spark, "evaluation-report")
    an.evaluation_report(B.frame_l(spark, sf), path)
    out = None
    for section, (_, key, metrics) in REPORT.items():
        df = rp.read_section(spark, path, section)
        cells = [f"named_struct('metric', '{m}', 'value', round(CAST({m} AS DOUBLE), {ROUND}))" for m in metrics]
        part = df.selectExpr(f"'{section}' AS section", f"{key.format(s='STRING')} AS key",
                             f"inline(array({', '.join(cells)}))")
        out = part if out is None else out.unionByName(part)
    return out


@register("per_label_csv",
          f"SELECT label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM ({ORACLE['per_label_report']})")
def q_per_label_csv(spark, sf):
    path = scratch_path(spark, "per-label-csv")
    rp.write_report({"per_label": an.per_label_report(B.frame_l(spark, sf))}, path, "csv")
    return rp.read_section(spark, path, "per_label", "csv").selectExpr(
        "label", "CAST(precision AS DOUBLE) AS precision", "CAST(recall AS DOUBLE) AS recall",
        "CAST(f1 AS DOUBLE) AS f1", "CAST(support AS BIGINT) AS support")


@register("text_report",
          "SELECT row_order, printf('%-16s%12.4f%12.4f%12.4f%12d', row_name, precision, recall, f1, support) AS line "
          f"FROM ({ORACLE['classification_report']})")
def q_text_report(spark, sf):
    path = scratch_path(spark, "text-report")
    rp.write_text_report(ev.classification_report(B.frame_l(spark, sf), 0.5, "gt"), f"{path}/report")
    return spark.read.text(f"{path}/report").selectExpr(
        "CAST(split(value, '\t')[0] AS INT) AS row_order", "split(value, '\t')[1] AS line")


@register("detailed_predictions_round_trip", ORACLE["detailed_predictions"])
def q_detailed_predictions_round_trip(spark, sf):
    path, ef = scratch_path(spark, "detailed-predictions"), B.frame_l(spark, sf)
    rp.write_detailed_predictions(ef, path)
    schema = ", ".join([f"{c} {'int' if c == 'l_linenumber' else 'bigint'}" for c in B.L_KEYS]
                       + [f"{n}_prob double" for n in L_NAMES] + [f"{n}_pred int" for n in L_NAMES]
                       + [f"{n}_true double" for n in L_NAMES])
    return rp.read_detailed_predictions(spark, path, schema)


# --- G1, G2: streaming, compared with the batch SQL ------------------------------------------

from ..streaming import history as hs  # noqa: E402
from ..streaming import scoring_stream as ss  # noqa: E402


@register("score_stream",
          f"WITH {CENT_SQL}, nm AS (SELECT * FROM (VALUES "
          + ", ".join(f"({i}, {O.q(n)})" for i, n in enumerate(V_NAMES))
          + ") AS t(label_idx, name)), th AS (SELECT vec_id, CAST(vec_id % 12 AS DOUBLE) / 10.0::DOUBLE AS threshold "
          "FROM embeddings) SELECT sv.vec_id, th.threshold, arg_max(nm.name, sv.p) AS top_label, "
          f"round(max(sv.p), {SCORE_ROUND}) AS top_probability, coalesce(string_agg(nm.name, ',' ORDER BY sv.label_idx) "
          "FILTER (WHERE sv.p >= th.threshold), '') AS predicted, CAST(count_if(sv.p >= th.threshold) AS INTEGER) "
          "AS n_predicted FROM sv JOIN nm USING (label_idx) JOIN th USING (vec_id) WHERE th.threshold <= 1.0::DOUBLE "
          "GROUP BY sv.vec_id, th.threshold")
def q_score_stream(spark, sf):
    weights, bias = B.centroid_head(spark, sf)
    stream = (stream_table(spark, sf, "embeddings")
              .select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("features"),
                      ((F.col("vec_id") % 12).cast("double") / F.lit(10.0)).alias("threshold")))

    def scorer(df):
        s = sc.probabilities(sc.linear_head(df, weights, bias), 10)
        return sc.score_batch(s, V_NAMES, "threshold", "ge").select("vec_id", "threshold", "labels", "top")

    acc, rej = scratch_path(spark, "stream-accepted"), scratch_path(spark, "stream-rejected")
    q = ss.score_stream(stream, scorer, acc, rej, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    picked = F.filter("labels", lambda x: x["predicted"])
    return spark.read.parquet(acc).select(
        "vec_id", "threshold", F.col("top.name").alias("top_label"),
        F.round("top.probability", SCORE_ROUND).alias("top_probability"),
        F.array_join(F.transform(picked, lambda x: x["name"]), ",").alias("predicted"),
        F.size(picked).alias("n_predicted"))


# requests over documents: every 11th text blank, every 13th missing, thresholds up to 1.3
REQUEST_TEXT = "CASE WHEN doc_id % 11 = 0 THEN '   ' WHEN doc_id % 13 = 0 THEN NULL ELSE text END"


@register("score_stream_rejected",
          f"WITH r AS (SELECT doc_id, {REQUEST_TEXT} AS text, CASE WHEN doc_id % 7 <> 0 THEN "
          "CAST(doc_id % 14 AS DOUBLE) / 10.0::DOUBLE END AS t FROM documents) "
          "SELECT doc_id, coalesce(t, 0.5::DOUBLE) AS threshold, CASE WHEN text IS NULL THEN 'text_missing' "
          "WHEN len(text) < 1 THEN 'text_too_short' WHEN len(text) > 4000 THEN 'text_too_long' "
          "WHEN regexp_full_match(text, '\\s*') THEN 'text_blank' ELSE 'threshold_out_of_range' END AS reason FROM r "
          "WHERE text IS NULL OR len(text) < 1 OR len(text) > 4000 OR regexp_full_match(text, '\\s*') OR t > 1.0::DOUBLE")
def q_score_stream_rejected(spark, sf):
    stream = (stream_table(spark, sf, "documents")
              .selectExpr("doc_id", f"{REQUEST_TEXT} AS text",
                          "CASE WHEN doc_id % 7 <> 0 THEN CAST(doc_id % 14 AS DOUBLE) / 10.0D END AS threshold"))
    acc, rej = scratch_path(spark, "requests-accepted"), scratch_path(spark, "requests-rejected")
    q = ss.score_stream(stream, lambda df: df.select("doc_id", "threshold"), acc, rej,
                        scratch_path(spark, "requests-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(rej).select("doc_id", "threshold", "reason")


@register("recent_history_clear_stream", ORACLE["recent_history_clear"])
def q_recent_history_clear_stream(spark, sf):
    stream = stream_table(spark, sf, "events")
    sink = scratch_path(spark, "history-clear-sink")
    q = hs.recent_history_stream(stream, sink, scratch_path(spark, "history-clear-ckpt"),
                                 clear_type=B.CLEAR_EVENT)
    q.awaitTermination()
    return hs.latest_lists(spark, sink)


@register("recent_history_stream", ORACLE["recent_history"])
def q_recent_history_stream(spark, sf):
    stream = stream_table(spark, sf, "events")
    sink = scratch_path(spark, "history-sink")
    q = hs.recent_history_stream(stream, sink, scratch_path(spark, "history-ckpt"))
    q.awaitTermination()
    return hs.latest_lists(spark, sink)


# --- single-measure queries and label decoding (B2, B9, B10, E8, E9) ----------------------

from ..functions import sqltext as X  # noqa: E402


@register("exact_match",
          f"WITH {O.frame_l_sql()}, {O.counts_sql(K)} SELECT {O.sdiv('exact', 'n')} AS exact_match_accuracy, "
          f"{O.sdiv('exact', 'n')} AS subset_accuracy FROM c")
def q_exact_match(spark, sf):
    return ev.exact_match(B.frame_l(spark, sf))


@register("hamming_loss",
          f"WITH {O.frame_l_sql()}, {O.counts_sql(K)} SELECT {O.overall_exprs(K)['hamming_loss']} AS hamming_loss FROM c")
def q_hamming_loss(spark, sf):
    return ev.hamming_loss(B.frame_l(spark, sf))


@register("decode_labels",
          f"WITH {O.frame_l_sql()} SELECT {', '.join(B.L_KEYS)}, "
          f"{O.names_of(L_NAMES, [f'y{i}' for i in range(K)], 'clean')} AS true_labels, "
          f"{O.names_of(L_NAMES, [f'CAST({O.pred(i, 0.5)} AS INTEGER)' for i in range(K)], 'clean')} AS predicted_labels, "
          f"{O.names_of([B.L_EN[n] for n in L_NAMES], [f'CAST({O.pred(i, 0.5)} AS INTEGER)' for i in range(K)], B.l_dictionary().en('clean'))} "
          "AS predicted_labels_en FROM l")
def q_decode_labels(spark, sf):
    ef = B.frame_l(spark, sf)
    h = X.binarize("score", ef.k, [0.5] * ef.k, "gt")
    en = [ef.labels.en(n) for n in ef.names]
    return ef.df.selectExpr(*ef.keys, f"{X.decode_names('y_true', ef.names, 'clean')} AS true_labels",
                            f"{X.decode_names(h, ef.names, 'clean')} AS predicted_labels",
                            f"{X.decode_names(h, en, ef.labels.en('clean'))} AS predicted_labels_en")


@register("union_splits",
          f"WITH {D_SQL} SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(sum(quality) AS BIGINT) AS quality, "
          "CAST(sum(toxic) AS BIGINT) AS toxic FROM d GROUP BY split")
def q_union_splits(spark, sf):
    # the two raw splits of the corpus (the whole table, split by its rule),
    # concatenated again with their provenance
    d = B.frame_d(spark, sf)
    both = cp.union_splits(train=d.filter(F.col("split") == "train").drop("split"),
                           valid=d.filter(F.col("split") == "valid").drop("split"))
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                     F.sum("quality").cast("long").alias("quality"),
                                     F.sum("toxic").cast("long").alias("toxic"))


# --- missing values: one rule in every path -------------------------------------------------

# frame L with a null score in every 7th order and a NaN in every 11th (by column arithmetic)
DIRTY_SQL = (O.frame_l_sql().replace("l AS (SELECT", "l0 AS (SELECT", 1) + ", l AS (SELECT * REPLACE ("
             + ", ".join(f"CASE WHEN l_orderkey % 7 = {i} OR l_orderkey % 11 = {i} THEN "
                         f"CAST('-Infinity' AS DOUBLE) ELSE p{i} END AS p{i}" for i in range(K)) + ") FROM l0)")


def _dirty_l(spark, sf):
    ef = B.frame_l(spark, sf)
    p = ", ".join(f"CASE WHEN l_orderkey % 7 = {i} THEN NULL WHEN l_orderkey % 11 = {i} THEN CAST('NaN' AS DOUBLE) "
                  f"ELSE score[{i}] END" for i in range(ef.k))
    return ef.with_df(ef.df.withColumn("score", F.expr(f"array({p})")))


def _dirty_metrics_sql() -> str:
    return (f"WITH {DIRTY_SQL}, {O.counts_sql(K)}, {O.auc_sql(K)}, m AS ("
            + _labels_union(O.label_metric_exprs, ev.PER_LABEL_COLUMNS)
            + ") SELECT m.label_idx, m.label, m.precision, m.recall, m.f1, true_positive, false_positive, "
            "false_negative, true_negative, coalesce(auc.auc, 0.5::DOUBLE) AS auc, CAST(true_positive + false_positive "
            "+ false_negative + true_negative AS BIGINT) AS n FROM m JOIN auc USING (label_idx)")


@register("dirty_scores_metrics", _dirty_metrics_sql())
def q_dirty_scores_metrics(spark, sf):
    rep = an.per_label_report(_dirty_l(spark, sf))
    return rep.select("label_idx", "label", "precision", "recall", "f1", "true_positive", "false_positive",
                      "false_negative", "true_negative", "auc",
                      F.expr("true_positive + false_positive + false_negative + true_negative").alias("n"))


@register("dirty_overall_metrics",
          f"WITH {DIRTY_SQL}, {O.counts_sql(K)} SELECT {O.overall_exprs(K)['hamming_loss']} AS hamming_loss, "
          f"{O.overall_exprs(K)['exact_match_accuracy']} AS exact_match_accuracy, "
          f"{O.overall_exprs(K)['macro_f1']} AS macro_f1 FROM c")
def q_dirty_overall_metrics(spark, sf):
    return ev.overall_metrics(_dirty_l(spark, sf)).select("hamming_loss", "exact_match_accuracy", "macro_f1")


@register("dirty_label_combinations",
          ORACLE["top_label_combinations"].replace(O.frame_l_sql(), DIRTY_SQL))
def q_dirty_label_combinations(spark, sf):
    return an.label_combinations(_dirty_l(spark, sf))


@register("dirty_threshold_sweep", f"WITH {DIRTY_SQL}, {O.sweep_sql(K, TS)} SELECT * FROM sw")
def q_dirty_threshold_sweep(spark, sf):
    return an.threshold_sweep(_dirty_l(spark, sf), TS)


# run values: NaN at every 5th event, null at every 9th
DIRTY_VALUE = "CASE WHEN step % 9 = 0 THEN NULL WHEN step % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END"
DIRTY_H_SQL = (H_SQL.replace("h AS (SELECT", "h0 AS (SELECT", 1)
               + f", h AS (SELECT run_id, step, ts, metric, {DIRTY_VALUE} AS value FROM h0)")


def _dirty_h(spark, sf, metrics):
    return B.frame_h(spark, sf, metrics).withColumn("value", F.expr(DIRTY_VALUE))


@register("dirty_early_stop", _early_stop_sql("eval_f1", rn.DEFAULT_PATIENCE, rn.DEFAULT_MIN_DELTA)
          .replace(H_SQL, DIRTY_H_SQL))
def q_dirty_early_stop(spark, sf):
    return rn.early_stop(_dirty_h(spark, sf, ["eval_f1"]), "eval_f1")


@register("dirty_best_metric",
          f"WITH {DIRTY_H_SQL}, s AS (SELECT run_id, step, CASE WHEN NOT isnan(value) THEN value END AS value FROM h "
          "WHERE metric = 'eval_f1'), b AS (SELECT run_id, max(value) AS best_value, CAST(count(*) AS BIGINT) AS n_values "
          "FROM s GROUP BY run_id), bs AS (SELECT b.run_id, min(s.step) AS best_step FROM b LEFT JOIN s ON "
          "s.run_id = b.run_id AND s.value = b.best_value GROUP BY b.run_id) SELECT b.run_id, 'eval_f1' AS metric, "
          "best_value, best_step, CASE WHEN best_step IS NOT NULL THEN CAST((SELECT count(*) FROM s WHERE "
          "s.run_id = b.run_id AND s.step < bs.best_step) AS BIGINT) END AS best_position, n_values "
          "FROM b JOIN bs USING (run_id)")
def q_dirty_best_metric(spark, sf):
    return rn.best_metric(_dirty_h(spark, sf, ["eval_f1"]), "eval_f1", "max")


# --- operators that only other queries used ---------------------------------------------------


@register("reject_null_text",
          f"SELECT doc_id, {REQUEST_TEXT} IS NULL AS rejected FROM documents")
def q_reject_null_text(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", f"{REQUEST_TEXT} AS text")
    good, bad = cp.text_as_string(d)
    return (good.select("doc_id", F.lit(False).alias("rejected"))
            .unionByName(bad.select("doc_id", F.lit(True).alias("rejected"))))


@register("label_arrays",
          f"WITH {D_SQL} SELECT doc_id, split, CAST(quality AS VARCHAR) || ',' || CAST(toxic AS VARCHAR) AS labels FROM d")
def q_label_arrays(spark, sf):
    arrays = cp.to_label_array(B.frame_d(spark, sf).drop("text"), B.d_dictionary())
    return arrays.select("doc_id", "split", F.array_join("labels", ",").alias("labels"))


LABEL_THRESHOLDS = [0.3, 0.45, 0.6, 0.75]


@register("per_label_thresholds",
          f"WITH {O.frame_l_sql()} SELECT {', '.join(B.L_KEYS)}, "
          + " || ',' || ".join(f"CAST(CAST(p{i} >= {O.d(t)} AS INTEGER) AS VARCHAR)"
                               for i, t in enumerate(LABEL_THRESHOLDS)) + " AS predicted FROM l")
def q_per_label_thresholds(spark, sf):
    ef = B.frame_l(spark, sf)
    vec = X.binarize("score", ef.k, LABEL_THRESHOLDS, "ge")
    return ef.df.selectExpr(*ef.keys, f"{X.vector_key(vec, ef.k)} AS predicted")


@register("unlabelled_predictions",
          f"WITH {O.frame_l_sql()} SELECT {', '.join(B.L_KEYS)}, "
          + ", ".join(f"p{i} AS {n}_prob, CAST({O.pred(i, 0.5)} AS INTEGER) AS {n}_pred"
                      for i, n in enumerate(L_NAMES)) + " FROM l")
def q_unlabelled_predictions(spark, sf):
    # a file without label columns is told apart by its columns: predictions only
    ef = B.frame_l(spark, sf)
    wide = ef.df.select(*ef.keys, *[F.col("score")[i].alias(f"s_{n}") for i, n in enumerate(L_NAMES)])
    labelled = cp.detect_labels(wide, ef.labels)
    frame = from_wide(wide, ef.keys, ef.labels, truth_cols=L_NAMES if labelled else None,
                      score_cols=[f"s_{n}" for n in L_NAMES])
    return rp.detailed_predictions(frame, 0.5, "gt")


@register("statistics_round_trip", ORACLE["events_dataset_statistics"])
def q_statistics_round_trip(spark, sf):
    path, u = scratch_path(spark, "statistics"), B.frame_u(spark, sf)
    io.write_metadata(path, statistics=cp.dataset_statistics(u, B.u_dictionary()))
    return io.read_statistics(spark, path)


@register("run_log_round_trip",
          f"WITH {H_SQL} SELECT run_id, step, metric, value FROM h WHERE metric IN ('eval_f1', 'eval_loss')")
def q_run_log_round_trip(spark, sf):
    path = scratch_path(spark, "run-log")
    for name in ("eval_loss", "eval_f1", "learning_rate"):  # appended one after the other
        rn.append_run_log(B.frame_h(spark, sf, [name]), path)
    return rn.read_run_log(spark, path, ["eval_f1", "eval_loss"])


# several metrics of one step: five events in a row are one step
CURVE_STEP = "CAST((event_id - event_id % 5) / 5 AS BIGINT)"


@register("merged_training_curves",
          f"WITH {H_SQL.replace('event_id AS step', CURVE_STEP + ' AS step')} SELECT run_id, step, "
          + ", ".join((f"max(CASE WHEN metric = {O.q(m)} THEN value END) AS {m}" if m == "macro_auc" else
                       f"coalesce(max(CASE WHEN metric = {O.q(m)} THEN value END), 0.0::DOUBLE) AS {m}")
                      for m in rn.CURVE_METRICS) + " FROM h GROUP BY run_id, step")
def q_merged_training_curves(spark, sf):
    h = B.frame_h_events(spark, sf).withColumn("step", F.expr(CURVE_STEP.replace("BIGINT", "bigint")))
    return rn.training_curves(h)


from . import catalog_batches, catalog_fits, catalog_live, catalog_tuning  # noqa: E402,F401

"""Evaluation and corpus frames bound to the driver tables.

Each binding reads whole tables (column pruning and filters reach the parquet
scan) and derives labels and scores with plain column arithmetic, so the
work grows with the tables.  The matching DuckDB text lives in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dictionary import LabelDictionary, make_dictionary
from ..operators.frame import EvalFrame
from ..session import read_table

# ---------------------------------------------------------------------------
# Fixed values of the bindings (they define the fixtures, both engines use
# them): frame L labels, their score multipliers, frame U event labels, the
# run-log metric each event type stands for, and the text split rule.
# ---------------------------------------------------------------------------
L_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
L_LABELS = ("returned", "discounted", "bulk", "premium")
L_DESCRIPTIONS = {
    "returned": "l_returnflag = 'R'",
    "discounted": "l_discount >= 0.05",
    "bulk": "l_quantity >= 25",
    "premium": "l_extendedprice >= 50000",
}
L_EN = {"returned": "Returned", "discounted": "Discounted", "bulk": "Bulk", "premium": "Premium"}
U_LABELS = ("click", "error", "purchase", "signup", "view")
D_LABELS = ("quality", "toxic")
RUN_METRICS = {"click": "eval_loss", "view": "eval_f1", "purchase": "eval_accuracy",
               "signup": "train_loss", "error": "learning_rate"}
VALID_MODULUS = 5  # split = 'valid' when key % 5 = 0, else 'train'
CLEAR_EVENT = "signup"  # history fixture: a signup clears the user's history


def l_dictionary() -> LabelDictionary:
    return make_dictionary(L_LABELS, L_DESCRIPTIONS, L_EN)


# truth of frame L, one SQL condition per label (fixed, as L_DESCRIPTIONS)
L_TRUTH_SQL = (
    "l_returnflag = 'R'",
    "l_discount >= 0.05D",
    "l_quantity >= 25",
    "l_extendedprice >= 50000",
)


def l_score_sql(i: int, y: str) -> str:
    mix = f"((l_orderkey * {31 + i} + l_partkey * {17 + i} + l_linenumber * {7 + i}) % 1000)"
    return f"CAST({mix} AS DOUBLE) / 1000.0D * 0.7D + 0.3D * CAST({y} AS DOUBLE)"


def frame_l(spark: SparkSession, sf_dir: str) -> EvalFrame:
    li = read_table(spark, sf_dir, "lineitem")
    ys = [f"CAST({c} AS INT)" for c in L_TRUTH_SQL]
    df = li.selectExpr(*L_KEYS, f"array({', '.join(ys)}) AS y_true",
                       f"array({', '.join(l_score_sql(i, y) for i, y in enumerate(ys))}) AS score")
    return EvalFrame(df, L_KEYS, l_dictionary())


def frame_l_logits(spark: SparkSession, sf_dir: str) -> EvalFrame:
    """Frame L with the score turned into a logit z = (p - 0.5) * 6."""
    ef = frame_l(spark, sf_dir)
    z = ", ".join(f"(score[{i}] - 0.5D) * 6.0D" for i in range(ef.k))
    return ef.with_df(ef.df.selectExpr("*", f"array({z}) AS logit"))


# --- frame D: documents with their quality/toxic labels --------------------

def d_dictionary() -> LabelDictionary:
    return make_dictionary(D_LABELS, {"quality": "document is of good quality",
                                      "toxic": "document is toxic"})


def split_of(key) -> F.Column:
    return F.when(key % VALID_MODULUS == 0, F.lit("valid")).otherwise(F.lit("train"))


def frame_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, split, text, quality, toxic): the wide labelled corpus."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    # labels is keyed by doc_id, documents too: a plain equi-join; Catalyst
    # picks broadcast only if the statistics say the side is small.
    return (docs.join(labels, "doc_id")
            .select("doc_id", split_of(F.col("doc_id")).alias("split"), "text",
                    F.col("quality").cast("int").alias("quality"),
                    F.col("toxic").cast("int").alias("toxic")))


# --- frame U: events as a multi-hot of event types per user and day -------

def u_dictionary() -> LabelDictionary:
    return make_dictionary(U_LABELS)


def frame_u(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, day, split, click, error, purchase, signup, view)."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    day = F.to_date(F.col("ts"))
    g = ev.groupBy("user_id", day.alias("day")).agg(
        *[F.max((F.col("event_type") == n).cast("int")).alias(n) for n in U_LABELS])
    return g.select("user_id", "day", split_of(F.col("user_id")).alias("split"),
                    *U_LABELS)


# --- frame V: embeddings, one-hot of the class label ------------------------

def v_dictionary() -> LabelDictionary:
    return make_dictionary([f"class_{i}" for i in range(10)])


def frame_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, features array<double>, label, y_true array<int>)."""
    emb = read_table(spark, sf_dir, "embeddings")
    feats = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    y = F.array(*[(F.col("label") == i).cast("int") for i in range(10)])
    return emb.select("vec_id", feats.alias("features"), "label", y.alias("y_true"))


# --- frame H: events as run logs --------------------------------------------

def frame_h_events(spark: SparkSession, sf_dir: str, metrics=None) -> DataFrame:
    """(run_id, ts, event_id, metric, value): events read as metric records.

    ``metrics`` keeps only those metrics, filtered on the source column so
    the filter reaches the parquet scan (a filter on the mapped name cannot).
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id",
                                                    "event_type", "value")
    if metrics is not None:
        kinds = [k for k, v in RUN_METRICS.items() if v in set(metrics)]
        ev = ev.filter(F.col("event_type").isin(kinds))
    metric = F.create_map(*[x for k, v in RUN_METRICS.items() for x in (F.lit(k), F.lit(v))])
    return ev.select(F.col("user_id").alias("run_id"), "ts", "event_id",
                     metric[F.col("event_type")].alias("metric"), "value")


# --- frame V model: class centroids as a linear head ------------------------

CENTROID_SCALE = 10.0  # logits = 10 * (x . c_k - |c_k|^2 / 2)


def feature_dim(df: DataFrame, features: str = "features") -> int:
    """Length of the feature vectors; vectors of different lengths are an error."""
    row = df.select(F.size(features).alias("d")).filter("d > 0").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).first()
    if row.lo != row.hi:
        raise ValueError(f"{features} has vectors of {row.lo} to {row.hi} components")
    return row.hi or 0


def centroid_head(spark: SparkSession, sf_dir: str) -> tuple:
    """(weights K x d, bias K) from the class centroids of ``embeddings``.

    The centroids are one distributed aggregate (groupBy(label, dim), partial
    in the scan tasks); only the K x d result reaches the driver, as a
    model's parameters do.
    """
    emb = read_table(spark, sf_dir, "embeddings")
    cells = emb.select("label", F.posexplode("embedding").alias("dim", "x"))
    cent = cells.groupBy("label", "dim").agg(F.avg(F.col("x").cast("double")).alias("w"))
    k = v_dictionary().k  # one head per class of the V dictionary
    # the vectors' length bounds what is fetched: K x d numbers, as a model's
    d = feature_dim(emb, "embedding")
    rows = cent.filter((F.col("label") >= 0) & (F.col("label") < k) & (F.col("dim") < d)).collect()
    w = [[0.0] * d for _ in range(k)]
    for r in rows:
        w[r["label"]][r["dim"]] = r["w"]
    weights = [[CENTROID_SCALE * v for v in wk] for wk in w]
    bias = [-CENTROID_SCALE * 0.5 * sum(v * v for v in wk) for wk in w]
    return weights, bias


# --- frame H: run log with a global step --------------------------------------

def frame_h(spark: SparkSession, sf_dir: str, metrics=None) -> DataFrame:
    """(run_id, step, ts, metric, value): step = event_id, which grows with ts."""
    return frame_h_events(spark, sf_dir, metrics).select(
        "run_id", F.col("event_id").alias("step"), "ts", "metric", "value")

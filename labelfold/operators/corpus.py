"""Corpus building and statistics: normalisation, splits, validation,
label distribution, cardinality, dataset statistics and class weights.

Schema decisions (which column feeds which label) are made at plan time from
``df.columns``; every statistic is one aggregate (partial in the scan tasks,
one small final merge), with ``rollup(split)`` adding the "all" total in the
same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dictionary import LabelDictionary
from ..functions import sqltext as X

# --- B1, B5, B6, B7: normalisation ------------------------------------------


def detect_labels(df: DataFrame, labels: LabelDictionary) -> bool:
    """True when every label (or one of its aliases) is a column."""
    cols = set(df.columns)
    return all(n in cols or any(a in cols for a in labels.aliases.get(n, []))
               for n in labels.names)


def label_source(df: DataFrame, labels: LabelDictionary, name: str) -> Column:
    cols = set(df.columns)
    if name in cols:
        return F.col(f"`{name}`")
    for alias in labels.aliases.get(name, []):
        if alias in cols:
            return F.col(f"`{alias}`")
    return F.lit(0)


def normalize_labels(df: DataFrame, labels: LabelDictionary, text_col: str = "text",
                     keep: list | None = None) -> DataFrame:
    """B1: (keep..., text, one int column per label); a missing label is 0,
    an alias spelling is accepted, other columns are dropped."""
    out = [F.col(c) for c in (keep or [])]
    out.append(F.col(f"`{text_col}`").cast("string").alias("text"))
    for n in labels.names:
        out.append(F.coalesce(label_source(df, labels, n).cast("int"), F.lit(0)).alias(n))
    return df.select(*out)


def text_as_string(df: DataFrame, text_col: str = "text") -> tuple:
    """Text forced to string; null text goes to the reject output."""
    t = F.col(text_col).cast("string")
    d = df.withColumn(text_col, t)
    return d.filter(F.col(text_col).isNotNull()), d.filter(F.col(text_col).isNull())


def to_label_array(df: DataFrame, labels: LabelDictionary, name: str = "labels") -> DataFrame:
    """Wide label columns -> one array<int> column."""
    arr = F.array(*[F.col(f"`{n}`").cast("int") for n in labels.names])
    keep = [c for c in df.columns if c not in labels.names]
    return df.select(*[F.col(f"`{c}`") for c in keep], arr.alias(name))


def union_splits(**splits: DataFrame) -> DataFrame:
    """B2: concatenate splits by column name, keeping provenance in ``split``."""
    out = None
    for name, df in splits.items():
        part = df.withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


# --- B3, B4: subsets and order ------------------------------------------------


def take_prefix(df: DataFrame, n: int, key: str, split_col: str = "split",
                train: str = "train", valid: str = "valid") -> DataFrame:
    """First n train rows and first n // 5 valid rows by ``key``
    (TakeOrderedAndProject per split; files have no order of their own)."""
    tr = df.filter(F.col(split_col) == train).orderBy(key).limit(n)
    va = df.filter(F.col(split_col) == valid).orderBy(key).limit(max(n // 5, 0))
    return tr.unionByName(va)


def portable_hash(*cols: Column) -> Column:
    """First 32 bits of md5 over the ':'-joined values, as a bigint (same value
    in other engines, unlike xxhash64)."""
    s = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long")


def shuffle_key(key: Column, seed: int, epoch: int, portable: bool = False) -> Column:
    if portable:
        return portable_hash(key, F.lit(seed), F.lit(epoch))
    return F.xxhash64(key, F.lit(seed), F.lit(epoch))


def shuffle_rows(df: DataFrame, key: str, seed: int = 42, epoch: int = 0,
                 portable: bool = False, sort: bool = True) -> DataFrame:
    """Reproducible per-epoch order, independent of partitioning."""
    out = df.withColumn("shuffle_key", shuffle_key(F.col(key), seed, epoch, portable))
    return out.orderBy("shuffle_key", key) if sort else out


# --- B11: request validation ----------------------------------------------------

# Request limits of the prediction API.
MIN_TEXT_CHARS = 1
MAX_TEXT_CHARS = 4000
THRESHOLD_RANGE = (0.0, 1.0)
DEFAULT_THRESHOLD = 0.5


def reject_reason(text: Column, threshold: Column, min_len: int = MIN_TEXT_CHARS,
                  max_len: int = MAX_TEXT_CHARS, t_lo: float = THRESHOLD_RANGE[0],
                  t_hi: float = THRESHOLD_RANGE[1]) -> Column:
    n = F.length(text)
    return (F.when(text.isNull(), F.lit("text_missing"))
            .when(n < min_len, F.lit("text_too_short"))
            .when(n > max_len, F.lit("text_too_long"))
            .when(text.rlike(r"^\s*$"), F.lit("text_blank"))
            .when(threshold.isNull(), F.lit(None))
            .when((threshold < t_lo) | (threshold > t_hi), F.lit("threshold_out_of_range")))


def validate_requests(df: DataFrame, text_col: str = "text", threshold_col: str = "threshold",
                      **limits) -> DataFrame:
    """One pass adding ``reason`` (null when accepted); a null threshold
    takes the default.  Split with ``accepted``/``rejected``."""
    t = F.coalesce(F.col(threshold_col).cast("double"), F.lit(DEFAULT_THRESHOLD))
    return (df.withColumn(threshold_col, t)
            .withColumn("reason", reject_reason(F.col(text_col), F.col(threshold_col), **limits)))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reason").isNull()).drop("reason")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reason").isNotNull())


# --- C1-C3: statistics --------------------------------------------------------------


def _split_stats_row(df: DataFrame, labels: LabelDictionary, by: str | None,
                     total_name: str = "all") -> DataFrame:
    """One row per split plus the total ("all"), from one rollup aggregate."""
    bits = [f"CAST({X.ident(n)} AS INT)" for n in labels.names]
    card = " + ".join(bits)
    aggs = ["count(1) AS n", f"sum({card}) AS card_sum", f"max({card}) AS card_max",
            f"count_if(({card}) = 0) AS none", f"count_if(({card}) > 1) AS several"]
    aggs += [f"sum({b}) AS c_{i}" for i, b in enumerate(bits)]
    if by is None:
        return df.agg(*[F.expr(a) for a in aggs]).withColumn("split", F.lit(total_name))
    g = df.rollup(by).agg(*[F.expr(a) for a in aggs], F.grouping(by).alias("_g"))
    named = g.withColumn("_split", F.expr(f"CASE WHEN _g = 1 THEN {X.lit(total_name)} "
                                          f"ELSE CAST({X.ident(by)} AS STRING) END"))
    return named.drop("_g", by).withColumnRenamed("_split", "split")


SPLIT_COLUMNS = ["split", "CAST(n AS BIGINT) AS total_samples",
                 f"{X.safe_div('card_sum', 'n')} AS avg_labels_per_sample",
                 "CAST(card_max AS BIGINT) AS max_labels_per_sample",
                 "CAST(none AS BIGINT) AS samples_with_no_labels",
                 "CAST(several AS BIGINT) AS samples_with_multiple_labels"]


def _label_rows(labels: LabelDictionary) -> str:
    structs = [X.named_struct([("label_idx", X.lit(i)), ("label", X.lit(n)),
                               ("count", f"CAST(c_{i} AS BIGINT)"),
                               ("percentage", f"{X.safe_div(f'c_{i}', 'n')} * 100.0D")])
               for i, n in enumerate(labels.names)]
    return f"inline({X.array_of(structs)})"


def label_distribution(df: DataFrame, labels: LabelDictionary, by: str | None = "split") -> DataFrame:
    """(split, label_idx, label, count, percentage) with the 'all' total."""
    row = _split_stats_row(df, labels, by)
    return row.selectExpr("split", _label_rows(labels))


def cardinality_stats(df: DataFrame, labels: LabelDictionary, by: str | None = "split") -> DataFrame:
    """Rows, mean/max labels per row, rows with none, rows with several."""
    return _split_stats_row(df, labels, by).selectExpr(*SPLIT_COLUMNS)


def dataset_statistics(df: DataFrame, labels: LabelDictionary, by: str | None = "split") -> DataFrame:
    """C1 and C2 together, one row per (split, label), from one aggregate."""
    return statistics_of_rows(_split_stats_row(df, labels, by), labels)


def statistics_of_rows(rows: DataFrame, labels: LabelDictionary) -> DataFrame:
    """``dataset_statistics`` from rows of split sums."""
    return rows.selectExpr(*SPLIT_COLUMNS, _label_rows(labels))


# --- C4-C7: class weights -------------------------------------------------------------

INVERSE_FREQUENCY_EPS = 1e-6


def half_even_ratio_sql(num: str, den: str, digits: int = 3) -> str:
    """Exact half-to-even rounding of the rational num/den to ``digits``
    (integer arithmetic only, as ``half_even_ratio``)."""
    scale = 10 ** digits
    n = f"(CAST({num} AS BIGINT) * {scale})"
    d0 = f"CAST({den} AS BIGINT)"
    d = f"(CASE WHEN {d0} = 0 THEN 1 ELSE {d0} END)"
    r = f"pmod({n}, {d})"
    q = f"CAST(({n} - {r}) / {d} AS BIGINT)"
    q_adj = (f"CASE WHEN {r} * 2 > {d} THEN {q} + 1 "
             f"WHEN {r} * 2 = {d} AND {q} % 2 = 1 THEN {q} + 1 ELSE {q} END")
    return f"(CASE WHEN {d0} = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST({q_adj} AS DOUBLE) / {X.lit(float(scale))} END)"


def class_weights(df: DataFrame, labels: LabelDictionary, method: str = "neg_pos",
                  splits: list | None = ("train",), split_col: str = "split",
                  drop_empty: bool = False) -> DataFrame:
    """(label_idx, label, n_pos, n_neg, pos_weight).

    By default only the train split counts, so no prior of the validation rows
    leaks into training, and a label without positives stays with weight 1.0;
    ``splits=None, drop_empty=True`` is the parity mode (every row counts, such
    labels are dropped).  A frame without a split column counts whole.

    neg_pos            n_neg/n_pos rounded half-even to 3 digits
    balanced           n_neg/n_pos unrounded, 1.0 without positives
    inverse_frequency  1/(freq + 1e-6), scaled to sum to K
    other              1.0
    """
    src = df if splits is None or split_col not in df.columns else df.filter(F.col(split_col).isin(list(splits)))
    row = src.agg(F.expr("count(1) AS n"),
                  *[F.expr(f"coalesce(sum(CAST({X.ident(n)} AS BIGINT)), 0) AS c_{i}")
                    for i, n in enumerate(labels.names)])
    return weights_of_counts(row, labels, method, drop_empty)


def weights_of_counts(row: DataFrame, labels: LabelDictionary, method: str = "neg_pos",
                      drop_empty: bool = False) -> DataFrame:
    """``class_weights`` from the one row of counts (n, c_0, c_1, ...)."""
    k = labels.k
    pos = [f"c_{i}" for i in range(k)]
    neg = [f"(n - c_{i})" for i in range(k)]
    if method == "neg_pos":
        w = [f"CASE WHEN {p} > 0 THEN {half_even_ratio_sql(ng, p, 3)} ELSE 1.0D END"
             for p, ng in zip(pos, neg)]
    elif method == "balanced":
        w = [f"CASE WHEN {p} > 0 THEN CAST({ng} AS DOUBLE) / CAST({p} AS DOUBLE) ELSE 1.0D END"
             for p, ng in zip(pos, neg)]
    elif method == "inverse_frequency":
        raw = [f"(1.0D / ({X.safe_div(p, 'n')} + {X.lit(INVERSE_FREQUENCY_EPS)}))" for p in pos]
        total = "(" + " + ".join(raw) + ")"
        w = [f"{r} / {total} * {X.lit(float(k))}" for r in raw]
    else:
        w = ["1.0D" for _ in pos]
    structs = [X.named_struct([("label_idx", X.lit(i)), ("label", X.lit(n)),
                               ("n_pos", f"CAST({pos[i]} AS BIGINT)"),
                               ("n_neg", f"CAST({neg[i]} AS BIGINT)"), ("pos_weight", w[i])])
               for i, n in enumerate(labels.names)]
    out = row.select(X.inline_rows(structs))
    if method == "neg_pos" and drop_empty:
        out = out.filter(F.col("n_pos") > 0)
    return out


# --- B12: flatten metrics -------------------------------------------------------------


def flatten_metrics(overall: DataFrame, prefix: str = "") -> DataFrame:
    """(name, value): every numeric overall column as ``overall_<name>``
    and the mean precision/recall/F1 over labels, which are its macro columns
    (one projection of one row, no second scan)."""
    num = [f.name for f in overall.schema.fields
           if f.dataType.typeName() in ("double", "float", "long", "integer")]
    named = [(f"{prefix}overall_{c}", c) for c in num]
    named += [(f"{prefix}avg_{m}", f"macro_{m}") for m in ("precision", "recall", "f1")]
    return overall.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(c).cast("double").alias("value")) for name, c in named])))

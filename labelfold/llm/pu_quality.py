"""Operator 4: quality classifier by positive-unlabelled learning.

Trusted positives (quality 1) and unlabelled web text train a small network that
minimises the non-negative unbiased risk

    prior * E_pos[l(f)] + max(0, E_unl[l(-f)] - prior * E_pos[l(-f)])

with the logistic loss, so its sigmoid estimates the probability of a good text.
The class prior is estimated from the training labels: the share of quality 1
among labelled rows outside the held-out fold (without any quality 0 there it
falls back to ``PRIOR``).  Rows of quality 0 are never shown as negatives.

The fit runs on at most ``fit_rows`` positives and ``fit_rows`` unlabelled rows
(a documented bound: the rows with the smallest hashes of id and text, which any
partitioning gives alike, in that order); every document is scored, from its whole text, in one
narrow pass.  Only features cross to the driver: at most
``2 * fit_rows * len(FEATURES)`` doubles.

Inputs of a score are features of the text alone.  Defined results: a null text is
empty and gets the score of the empty text's features; a null label, and a null
id among the labels, teaches nothing; a null id is scored (crc32 of the empty
text decides its fold); repeated rows score alike; several labels of one id
teach by their largest; without any trusted positive every score is the prior;
an empty table gives an empty table; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelfold.llm.common import text_of

#: Scores from here on predict quality 1.
THRESHOLD = 0.3
#: Class prior when the labels hold no quality 0 (none can be estimated).
PRIOR = 0.8

FEATURES = (
    "log_words", "log_chars", "word_len", "word_len_sd", "long_words", "upper", "digit", "letter", "mark",
    "stop_mark", "bars", "shout", "odd", "non_ascii", "lines", "line_words", "distinct", "top_word", "top_pair",
    "repeat_next", "line_repeat", "capital_words", "mark_words", "digit_words", "tiny_words",
)

_CLASS = np.zeros(256, dtype=np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (1 if "A" <= _c <= "Z" else 2 if "a" <= _c <= "z" else 3 if _c.isdigit() and _b < 128
                  else 4 if _b >= 0xC0 else 5 if _b >= 128 else 6 if _c in ".,;" else 7 if _c in "|" else
                  8 if _c in "!?" else 9 if _c in " \t\n\r\x0b\x0c" else 10)


def features(text: str) -> np.ndarray:
    """FEATURES of a whole text."""
    words = text.split()
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    n = np.bincount(_CLASS[raw], minlength=11) if len(raw) else np.zeros(11, dtype=np.int64)
    chars, k = max(1, int(n.sum() - n[5])), len(words)
    seen = np.maximum(1, chars - n[9])
    lens = np.fromiter(map(len, words), dtype=np.int64, count=k)
    mean, sd = (float(lens.mean()), float(lens.std())) if k else (0.0, 0.0)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs: dict[tuple, int] = {}
    for p in zip(words, words[1:]):
        pairs[p] = pairs.get(p, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    d = max(1, k)
    return np.array([
        np.log1p(k), np.log1p(chars), mean, sd, float((lens > 20).sum()) / d, n[1] / seen, n[3] / seen,
        (n[1] + n[2] + n[4]) / seen, n[10] / seen, n[6] / seen, n[7] / seen, n[8] / seen,
        (n[7] + n[8] + n[10]) / seen, n[4] / seen, np.log1p(len(lines)), np.log1p(k / max(1, len(lines))),
        len(counts) / d, max(counts.values(), default=0) / d, max(pairs.values(), default=0) / d,
        sum(a == b for a, b in zip(words, words[1:])) / d, 1 - len(set(lines)) / max(1, len(lines)),
        sum(w[0].isupper() for w in words) / d, sum(not w[-1].isalnum() for w in words) / d,
        sum(w.isdigit() for w in words) / d, float((lens <= 2).sum()) / d,
    ])


class Network:
    """One hidden layer over standardised features."""

    def __init__(self, mean, scale, weights):
        self.mean, self.scale, self.weights = mean, scale, weights

    def score(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return 1 / (1 + np.exp(-np.clip(np.tanh(z @ w1 + b1) @ w2 + b2, -30, 30)))


def fit_pu(pos: np.ndarray, unl: np.ndarray, prior: float, hidden: int = 16, steps: int = 600,
           rate: float = 0.02, decay: float = 1e-4, seed: int = 4) -> Network:
    """Minimise the non-negative unbiased risk with Adam steps on all rows given."""
    both = np.vstack([pos, unl])
    mean, scale = both.mean(0), both.std(0) + 1e-9
    zp, zu = (np.clip((x - mean) / scale, -6, 6) for x in (pos, unl))
    rng = np.random.default_rng(seed)
    w = [rng.normal(0, 0.3, (both.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.3, hidden), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    sig = lambda f: 1 / (1 + np.exp(-np.clip(f, -30, 30)))

    def grads(z, h, g):
        """Gradients when g is the derivative of the risk by f(z)."""
        back = np.outer(g, w[2]) * (1 - h * h)
        return [z.T @ back, back.sum(0), h.T @ g, np.array([g.sum()])]

    for step in range(1, steps + 1):
        hp, hu = np.tanh(zp @ w[0] + w[1]), np.tanh(zu @ w[0] + w[1])
        fp, fu = hp @ w[2] + w[3], hu @ w[2] + w[3]
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        if negative >= 0:  # the unbiased risk
            gp = prior * ((sig(fp) - 1) - sig(fp)) / len(fp)
            gu = sig(fu) / len(fu)
        else:  # the risk of negatives fell below zero: step back up on that part alone
            gp, gu = prior * sig(fp) / len(fp), -sig(fu) / len(fu)
        total = [a + b + decay * c for a, b, c in zip(grads(zp, hp, gp), grads(zu, hu, gu), w)]
        for i, g in enumerate(total):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            w[i] = w[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return Network(mean, scale, w)


def fold_of(id_col: str | Column) -> Column:
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def _features_of(batches):
    for df in batches:
        yield pd.DataFrame({"f": [features(x).tolist() for x in df["text"]]})


def fit_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", fit_rows: int = 8000) -> Network | float:
    """The fitted network, or the prior alone when there is no trusted positive."""
    known = (labels.select(F.col(id_col).alias("lid"), F.col(label_col).cast("int").alias("label"))
             .filter("lid is not null and label is not null").filter(fold_of("lid") != 0)
             .groupBy("lid").agg(F.max("label").alias("label")))
    share = known.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("double")).alias("p")).first()
    if not share.n or not share.p:
        return PRIOR
    prior = PRIOR if share.p == share.n else float(share.p) / share.n
    d = (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
         .withColumn("h", F.xxhash64("id", "text")))

    def smallest(part) -> np.ndarray:
        """Features of the fit_rows different rows of a part with the smallest hashes.

        Hashes alone find the limit; texts are then read below it only."""
        limit = part(d.select("id", "h")).select("h").distinct().orderBy("h").limit(fit_rows).agg(F.max("h")).first()[0]
        if limit is None:
            return np.zeros((0, len(FEATURES)))
        pick = part(d.filter(F.col("h") <= limit)).dropDuplicates(["h"]).orderBy("h").select("text")
        return np.array([r.f for r in pick.mapInPandas(_features_of, "f array<double>").collect()])

    of = F.col("id") == F.col("lid")
    pos = smallest(lambda x: x.join(known.filter("label = 1"), of, "left_semi"))
    unl = smallest(lambda x: x.filter(fold_of("id") != 0).join(known, of, "left_anti"))
    if not len(pos):
        return PRIOR
    if not len(unl):  # every document is labelled: the mixed rows, labels hidden, are the unlabelled text
        unl = smallest(lambda x: x.join(known, of, "left_semi"))
    return fit_pu(pos, unl, prior)


def _score(model, names: list[str]):
    def run(batches):
        for df in batches:
            if isinstance(model, float):
                s = np.full(len(df), model)
            elif len(df):
                s = model.score(np.vstack([features(x) for x in df["text"]]))
            else:
                s = np.zeros(0)
            yield df[names].assign(score=s)
    return run


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **fit) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    model = fit_classifier(docs, labels, id_col, text_col, **fit)
    rows = docs.select(F.col(id_col), text_of(text_col).alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    return (rows.mapInPandas(_score(model, [id_col]), f"{id_col} {kind}, score double")
            .select(id_col, (fold_of(id_col) == 0).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **fit) -> DataFrame:
    """The documents the classifier doesn't reject, with all their columns."""
    model = fit_classifier(docs, labels, id_col, text_col, **fit)
    names = docs.columns
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                      text_of(text_col).alias("text"))
    kinds = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    plain = [f"c{i}" for i in range(len(names))]
    return (own.mapInArrow(_keep_rows(model, plain), kinds)
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]))


def _keep_rows(model, plain: list[str]):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = b.column("text").to_pylist()
            s = (np.full(len(texts), model) if isinstance(model, float) else
                 model.score(np.vstack([features(x) for x in texts])) if texts else np.zeros(0))
            yield b.select(plain).filter(pa.array(s >= THRESHOLD))
    return run

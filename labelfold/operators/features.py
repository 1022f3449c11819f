"""Text features: fixed-length token encoding, length profile, hashed TF-IDF.

The reference's WordPiece encoder is a per-row library; here a text is split
on single spaces (Spark's ``split``), cut or padded to ``max_length`` with an
attention mask.  The length profile answers the question the encoder's
``max_length`` raises: what share of rows is truncated and how much padding
each candidate length costs.  Both are narrow projections plus one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The padding token and the tokeniser's length default.
PAD_TOKEN = "[PAD]"
DEFAULT_MAX_LENGTH = 512
PROFILE_LENGTHS = (64, 128, 256, 512, 1024)


def tokens(text: Column) -> Column:
    return F.split(text, " ")


def token_count(text: Column) -> Column:
    """size(split(text, ' ')) without building the array: spaces + 1."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + F.lit(1)


def encode_corpus(df: DataFrame, max_length: int = DEFAULT_MAX_LENGTH, text: str = "text") -> DataFrame:
    """Tokens cut/padded to ``max_length`` and the attention mask."""
    t = tokens(F.col(text))
    kept = F.slice(t, 1, max_length)
    n_kept = F.size(kept)
    pad = F.array_repeat(F.lit(PAD_TOKEN), F.greatest(F.lit(max_length) - n_kept, F.lit(0)))
    mask = F.concat(F.array_repeat(F.lit(1), n_kept),
                    F.array_repeat(F.lit(0), F.greatest(F.lit(max_length) - n_kept, F.lit(0))))
    return (df.withColumn("n_tokens", F.size(t))
              .withColumn("input_tokens", F.concat(kept, pad))
              .withColumn("attention_mask", mask))


def length_profile(df: DataFrame, lengths: Sequence[int] = PROFILE_LENGTHS, text: str = "text") -> DataFrame:
    """Per candidate length L, the share of rows longer than L (truncated)
    and the mean padding share max(L - n, 0) / L, all in one aggregate."""
    n = token_count(F.col(text))
    aggs = [F.count(F.lit(1)).alias("n_docs")]
    for L in lengths:
        aggs.append(F.count_if(n > L).alias(f"tr_{L}"))
        aggs.append(F.sum(F.greatest(F.lit(L) - n, F.lit(0)).cast("long")).alias(f"pad_{L}"))
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(L).alias("max_length"),
                        F.col("n_docs").cast("long").alias("n_docs"),
                        F.col(f"tr_{L}").cast("long").alias("n_truncated"),
                        (F.col(f"tr_{L}") / F.col("n_docs")).alias("share_truncated"),
                        (F.col(f"pad_{L}") / (F.col("n_docs") * F.lit(float(L)))).alias("avg_padding_share"))
               for L in lengths]
    return row.select(F.inline(F.array(*structs)))


def term_frequencies(df: DataFrame, dim: int = 1 << 18, text: str = "text",
                     out: str = "tf") -> DataFrame:
    """D2, first half: lower-cased whitespace tokens hashed into ``dim``
    term-frequency buckets; words that share a bucket are counted together, so
    ``dim`` should be well above the vocabulary (a narrow projection; persist it when it feeds
    both an IDF fit and a model fit, so the texts are tokenized once)."""
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    tok = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern="\\s+", toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol=out, numFeatures=dim)
    return tf.transform(tok.transform(df)).drop("_tokens")


def inverse_document_frequency(tf_df: DataFrame, tf: str = "tf", out: str = "features"):
    """D2, second half: fit IDF (one distributed document-frequency aggregate
    of ``dim`` counts) and weight the term frequencies.  Returns (frame, model)."""
    from pyspark.ml.feature import IDF

    model = IDF(inputCol=tf, outputCol=out).fit(tf_df)
    return model.transform(tf_df).drop(tf), model


def text_features(df: DataFrame, dim: int = 1 << 18, text: str = "text", out: str = "features",
                  idf: bool = True):
    """Hashed term frequencies (+ IDF) as an ML vector column.

    Returns (frame, fitted IDF model or None).  The IDF fit is one distributed
    document-frequency aggregate; the transform is a narrow projection.
    """
    if not idf:
        return term_frequencies(df, dim, text, out), None
    return inverse_document_frequency(term_frequencies(df, dim, text, "_tf"), "_tf", out)


TOKEN_GAP = r"[\x20\x09-\x0D]+"


def bucket_counts(df: DataFrame, key: str, dim: int = 1 << 18, text: str = "text") -> DataFrame:
    """(key, bucket, tf) of every non-zero cell.  Buckets are the first 32 bits of a token's MD5
    modulo ``dim``, a hash any engine computes alike; counts combine on the map side."""
    token = F.explode(F.split(F.lower(F.col(text)), TOKEN_GAP))
    return (df.select(key, token.alias("t")).filter("t <> ''")
            .select(key, F.expr(f"CAST(conv(substr(md5(t), 1, 8), 16, 10) AS BIGINT) % {dim}").alias("bucket"))
            .groupBy(key, "bucket").agg(F.count(F.lit(1)).alias("tf")))


def weighted_counts(counts: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """(key, bucket, tf, tfidf) of the counts of a frame's texts, idf = ln((n + 1) / (df + 1)).

    The counts are read twice: write them first where the texts are many.  The bucket table joined
    back has at most ``dim`` rows."""
    df_of = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    n = df.agg(F.count(F.lit(1)).cast("double").alias("n"))
    # one row beside at most ``dim`` rows
    idf = df_of.join(F.broadcast(n)).select("bucket", F.expr("ln((n + 1D) / (df + 1D))").alias("idf"))
    return counts.join(F.broadcast(idf), "bucket").select(key, "bucket", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def tfidf_cells(df: DataFrame, key: str, dim: int = 1 << 18, text: str = "text") -> DataFrame:
    """D2 in long form: (key, bucket, tf, tfidf) of every non-zero cell."""
    return weighted_counts(bucket_counts(df, key, dim, text), df, key)


def tfidf_vectors(df: DataFrame, key: str, dim: int = 1 << 18, text: str = "text", cells: DataFrame | None = None) -> DataFrame:
    """D2 as sparse rows: (key, indices array<int>, values array<double>), indices ascending.

    The cells of ``tfidf_cells`` (or those given) gathered per key; a row without tokens has empty arrays."""
    cells = tfidf_cells(df, key, dim, text) if cells is None else cells
    packed = cells.groupBy(key).agg(F.sort_array(F.collect_list(
        F.struct(F.col("bucket").cast("int").alias("i"), F.col("tfidf").alias("v")))).alias("cells"))
    empty = F.array().cast("array<struct<i:int,v:double>>")
    return (df.select(key).join(packed, key, "left").withColumn("cells", F.coalesce("cells", empty))
            .select(key, F.col("cells.i").alias("indices"), F.col("cells.v").alias("values")))

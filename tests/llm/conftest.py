import pytest

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))

#: Names that the operators use inside, as columns they must leave alone.
CLASHING = ("id", "h", "key", "norm", "sha", "size", "c0", "h2")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing columns."""
    rows = [
        (1, "one two three four five six seven", "en", "a"), (2, "one two three four five six seven", None, "a"),
        (2, "one two three four five six seven", None, "a"), (3, None, "en", None), (4, "", None, None),
        (5, " \t\n ", "en", "b"), (6, LONG, "en", "b"), (7, LONG, "de", "c"), (None, "one  two\tthree", None, None),
        (None, "lonely", "en", "a"), (8, "mail a.b@c.de +1 (555) 555-5555", "en", "a"), (9, "Ünï ço∂é 😀 tëxt", "en", "c"),
    ]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F
    return base.select("*", F.length("text").cast("long").alias("n_chars"), *[F.lit(f"x{c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def odd_pages(spark):
    big = "<article><p>" + "payload " * 300 + "</p></article>"
    rows = [(1, "http://a.net/en/x", big), (2, None, big), (3, "no scheme", None), (3, "no scheme", None),
            (4, "https://B.Example.NET/en/a?q#f", ""), (None, "http://x.org/fr/1\n2%", big),
            (5, "http://ex.org/", "<p>tiny"), (6, "http://ex.org/", "<p>tiny"),
            (7, "http://example.net", "<script>never ends <p>x"), (8, "", "<article><p>" + "long words here. " * 40_000)]
    base = spark.createDataFrame(rows, "page_id long, url string, html string")
    from pyspark.sql import functions as F
    return base.select("*", *[F.lit(f"x{c}").alias(c) for c in CLASHING])

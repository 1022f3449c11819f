"""SQL expression text: literals round-trip through Spark's parser."""

import math

import pytest

from labelfold.functions import sqltext as X


@pytest.mark.parametrize("value", [0.1, -2.5e-7, 1e300, 2 ** 40, -(2 ** 31), 7, "a'b\\c", "여성/가족",
                                   True, False])
def test_literal_round_trip(spark, value):
    got = spark.sql(f"SELECT {X.lit(value)} AS v").collect()[0]["v"]
    assert got == value and type(got) is type(value)


def test_special_doubles_and_null(spark):
    r = spark.sql(f"SELECT {X.lit(float('nan'))} AS a, {X.lit(float('inf'))} AS b, "
                  f"{X.lit(float('-inf'))} AS c, {X.lit(None)} AS d").collect()[0]
    assert math.isnan(r["a"]) and r["b"] == math.inf and r["c"] == -math.inf and r["d"] is None


def test_count_below_matches_python(spark):
    ts = [0.1, 0.3, 0.5, 0.7, 0.9]
    xs = [0.0, 0.1, 0.2, 0.5, 0.55, 0.9, 1.0]
    cols = ", ".join(f"{X.count_below(X.lit(x), ts)} AS gt{i}, {X.count_below(X.lit(x), ts, True)} AS ge{i}"
                     for i, x in enumerate(xs))
    r = spark.sql(f"SELECT {cols}").collect()[0]
    for i, x in enumerate(xs):
        assert r[f"gt{i}"] == sum(t < x for t in ts) and r[f"ge{i}"] == sum(t <= x for t in ts)

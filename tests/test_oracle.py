"""Every registered query against its DuckDB SQL on the smallest tables."""

import math

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() == 4 and "f1" in df.columns


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    cur = duck.execute(oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    assert sorted(dcols) == cols
    drows = sorted((tuple(norm(dict(zip(dcols, r))[c]) for c in cols) for r in cur.fetchall()), key=repr)
    assert srows == drows


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert queries()[name](spark, SF_SMALL).count() > 0

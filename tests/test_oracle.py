"""Every query with SQL agrees with it on the smallest tables; the others return rows of a stable schema."""

import math
import os

import duckdb
import pytest

from folioforge.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


def rows(df):
    out = []
    for r in df[sorted(df.columns)].itertuples(index=False):
        out.append(tuple("null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v) for v in (None if str(type(v)).endswith("NAType'>") else v for v in r)))
    return sorted(out)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck):
    got = QUERIES[name](spark, sf).toPandas()
    if name in ORACLE:
        want = duck.sql(ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got.columns) and not math.isnan(len(got))


def test_oracles_name_queries():
    assert set(ORACLE) <= set(QUERIES)

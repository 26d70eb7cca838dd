"""Every query of the library runs, and gives what its SQL gives, on the smallest tables."""

import math

import duckdb
import pytest

import quire.plans.queries_rows  # noqa: F401
import quire.plans.queries_text  # noqa: F401
from quire.plans.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return str(v)[:19] if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    if name not in SQL:
        assert len(got) > 0
        return
    rel = con.sql(SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in rel.fetchall())

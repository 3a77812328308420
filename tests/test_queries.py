"""Each registered query of the engine against its SQL, on the smallest driver tables."""

import os

import duckdb
import pytest

from docloom.plans.registry import ORACLES, QUERIES

DATA = os.environ.get("QUERY_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are absent")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def cells(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if v is None else round(v, 6) if isinstance(v, float) else v
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DATA)
    got = cells(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLES:
        rel = db.sql(ORACLES[name])
        assert got == cells(rel.columns, rel.fetchall())
    else:
        assert got[1]

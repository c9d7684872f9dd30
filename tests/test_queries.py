"""Each registered query of the library's own operators against its DuckDB equivalent, on the smallest tables."""

import os

import duckdb
import pytest

from streamcurate import catalog_of_queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(rows):
    def one(x):
        if x is None or x != x:
            return "-"
        return f"{float(x):.5f}".replace("-0.00000", "0.00000") if isinstance(x, (int, float)) or type(x).__name__ == "Decimal" else str(x)

    return sorted(tuple(map(one, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog_of_queries.oracle_sql()))
def test_query(spark, duck, name):
    got = catalog_of_queries.queries()[name](spark, DATA)
    want = duck.execute(catalog_of_queries.oracle_sql()[name])
    names = sorted(c[0] for c in want.description)
    assert sorted(got.columns) == names
    at = [[c[0] for c in want.description].index(n) for n in names]
    assert plain(got.select(*names).collect()) == plain([[r[i] for i in at] for r in want.fetchall()])

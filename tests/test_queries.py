"""Every query with an oracle equals DuckDB on the smallest tables."""

import importlib
import math
import os

import pytest

SF = os.environ.get("PIPEWATCH_TEST_SF", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
entry = importlib.import_module("__spark_entry__")
TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(x + 0.0)
        return repr(x)

    return sorted(tuple(one(r[i]) for i in order) for r in rows)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cur.fetchall(), columns)

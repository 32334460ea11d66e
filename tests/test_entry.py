import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__

from heddle.plans import queries as core

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the given tables aren't here")


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return c


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(None if r[i] is None else round(r[i], 6) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows]
    return sorted(plain, key=repr), sorted(columns)


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_queries_agree_with_sql(spark, sql, name):
    df = core.queries()[name](spark, DATA)
    cur = sql.execute(core.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(cur.fetchall(), columns)


def test_every_query_without_sql_runs(spark):
    for name in sorted(set(core.queries()) - set(core.oracle_sql())):
        assert core.queries()[name](spark, DATA).count() >= 0, name


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

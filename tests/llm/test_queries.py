import os

import duckdb
import pytest

from heddle.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the given tables aren't here")
COLUMNS = {"p1_found": ["item_id", "line_no"], "p3_found": ["item_id_a", "item_id_b"], "p4_found": ["item_id", "field"], "p5_found": ["name_a", "name_b"], "p7_found": ["doc_id", "item_id"], "p8_found": ["doc_id", "subject"]}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_runs(spark, name):
    df = queries.queries()[name](spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and len(rows) == len(set(rows))
    if name in queries.oracle_sql():
        c = duckdb.connect()
        for t in ("items", "documents", "benchmark"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
        assert sorted(rows, key=repr) == sorted(c.execute(queries.oracle_sql()[name]).fetchall(), key=repr)

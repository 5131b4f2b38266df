"""The registered queries: those with SQL against it, the others against their columns."""

import glob
import os

import duckdb
import pytest

from claimlake.llm import queries

HOME = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["arrival", "field"], "p2_found": ["arrival", "line_no"], "p4_found": ["arrival", "field", "label_id"], "p6_found": ["arrival", "field"], "p7_found": ["arrival", "accepted_item_id"],
    "p8_packed": ["doc_id", "piece", "start_token", "n_tokens", "container"], "p9_found": ["doc_id", "eval_id"], "p10_found": ["doc_id", "kind", "start_pos"],
}
pytestmark = pytest.mark.skipif(not os.path.isdir(HOME), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns(spark, name):
    df = queries.QUERIES[name](spark, HOME)
    assert df.columns == COLUMNS[name] and df.count() > 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{HOME}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    assert sorted(map(tuple, queries.QUERIES[name](spark, HOME).collect())) == sorted(con.sql(queries.SQL[name]).fetchall())

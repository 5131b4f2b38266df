"""The registered core queries against their SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

from claimlake.plans import queries

HOME = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(HOME), reason="no test tables")


def rows(df: pd.DataFrame) -> list[str]:
    plain = lambda v: None if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)) else round(v, 9) if isinstance(v, float) else v.item() if hasattr(v, "item") else v
    return sorted(repr(tuple(map(plain, r))) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET timezone='UTC'")
    for f in glob.glob(f"{HOME}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, db, name):
    ours, theirs = queries.QUERIES[name](spark, HOME).toPandas(), db.sql(queries.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, HOME).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_core_does_not_need_the_training_subpackage():
    import subprocess
    import sys

    code = "import sys; sys.modules['claimlake.llm'] = None; import __spark_entry__ as e; assert not any(q == 'p1_found' for q in e.queries()); print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), check=False)
    assert done.returncode == 0, done.stderr

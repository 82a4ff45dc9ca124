import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
from cartograph.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")

LIBRARY = sorted(catalog.QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "f1", "f2", "f3"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries()) and set(LIBRARY) <= set(E.queries())


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = [tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return sorted(norm, key=repr)


@pytest.mark.parametrize("name", LIBRARY)
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("events", "orders", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(res.columns, res.fetchall())

"""Queries that SQL can express, against DuckDB over the small tables."""

import duckdb
import pytest

from ledgerline.llm import queries
from tests.llm.helpers import SMALL


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_against_sql(spark, key):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    cur = con.execute(queries.ORACLE[key])
    names = sorted(d[0] for d in cur.description)
    want = sorted((tuple(str(v) for _, v in sorted(zip([d[0] for d in cur.description], r))) for r in cur.fetchall()))
    got = queries.QUERIES[key](spark, SMALL)
    assert sorted(got.columns) == names
    assert sorted(tuple(str(r[c]) for c in names) for r in got.collect()) == want


def test_queries_in_order():
    assert [k.split("_")[0] for k in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]

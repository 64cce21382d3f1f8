"""Every registered query against its DuckDB oracle on sf0.001 (the driver uses sf0.01)."""

import datetime as dt
import decimal
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.plans import registry
from ledgerline.sources.tables import TABLE_NAMES

from conftest import SF_SMALL

KEYS = sorted(registry.PLANS)


def norm(v):
    if isinstance(v, decimal.Decimal):
        return ("n", str(v.normalize()))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("n", str(decimal.Decimal(v).normalize()))
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    return (type(v).__name__, v)


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


def test_everything_but_the_optional_operators_works_without_them(tmp_path):
    """Without the folder of the pipeline operators, and without the script that uses it, the rest still imports."""
    code = """
import importlib.abc, sys
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.startswith(BLOCKED):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
for BLOCKED in ("ledgerline.llm", "corpus_pipeline"):
    for m in [m for m in sys.modules if m.startswith(("ledgerline", "corpus_pipeline", "__spark_entry__"))]:
        del sys.modules[m]
    sys.meta_path.insert(0, Gone())
    import __spark_entry__ as E
    assert "item_quantity_in_year" in E.queries() and "pipeline" not in E.queries()
    assert set(E.oracle_sql()) <= set(E.queries())
    sys.meta_path.pop(0)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["stock_item_name", "total_quantity"]
    assert df.count() >= 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == canon(names, cur.fetchall())

"""Every registered report equals its DuckDB oracle (rows, columns, values)."""
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from clickscope.plans import reports
from clickscope.sources.tables import TABLES

from .conftest import SF_SMALL


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


REPORTS = sorted(reports.registry())


def test_every_report_has_an_oracle():
    assert set(REPORTS) <= set(E.queries())
    assert set(REPORTS) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["area", "product_name", "clicount", "remark"]
    assert df.count() > 0


@pytest.mark.parametrize("key", REPORTS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = [tuple(r) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)

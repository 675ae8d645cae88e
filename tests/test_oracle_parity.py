"""Every registered key equals its DuckDB oracle on sf0.001 (the t2 gate, small)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from marketlens.sources.tables import TABLES

# The optional training-data queries are tested in their own folder.
KEYS = sorted(k for k in E.queries() if k != "pipeline" and not (k.startswith("op") and k[2].isdigit()))
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(ORACLE)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, sf_dir, duck, key):
    df = E.queries()[key](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["category", "city"]
    assert df.count() > 0

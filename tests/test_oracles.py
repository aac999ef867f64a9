"""Every registered query against its SQL oracle (DuckDB) on the smallest data."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tessera.plans.oracles import ORACLES
from tessera.plans.queries import QUERIES

TABLES = ["embeddings", "pages", "labels", "events", "orders"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle_or_is_known_rows_only():
    rows_only = {"image_job"}
    missing = set(QUERIES) - set(ORACLES) - rows_only
    assert not missing, missing
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _rows(df.columns, srows) == _rows(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["label_idx", "tp"]

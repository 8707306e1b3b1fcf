"""Every registered query against its DuckDB oracle (row multiset, names, values)."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from cartwheel.plans import catalog
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return repr(v)


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


ORACLES = dict(catalog.oracles())


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(scols) == sorted(ocols)
    names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    stypes = {f.name: names.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    otypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert stypes == otypes
    assert len(srows) == len(orows)
    assert _canon(srows, scols) == _canon(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert rows[-1]["traffic_source"] == "ALL"


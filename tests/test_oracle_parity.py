"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import hashlib

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None or (isinstance(v, float) and pd.isna(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def _digest(df):
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))
    return hashlib.sha1("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    o = con.sql(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert _digest(s) == _digest(o)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["wallet", "anomaly_score", "raw_score", "final_score"]
    assert df.count() > 0

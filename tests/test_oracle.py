"""Every query with SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import numbers
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from psmlake import queries

SF = Path("/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def shown(value):
    if pd.api.types.is_scalar(value) and pd.isna(value):
        return "null"
    return f"{float(value):.6g}" if isinstance(value, numbers.Number) else str(value)


def canon(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(map(shown, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = canon(queries.queries()[name](spark, str(SF)).toPandas())
    want = canon(duck.execute(queries.oracle_sql()[name]).df())
    assert got == want


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(queries.oracle_sql()) <= set(queries.queries())

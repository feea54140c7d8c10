"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from suite.queries import QUERIES
from tools.compare import TABLES, compare


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    result = compare(spark, con, sf_dir, name)
    assert result.startswith("ok") and "types differ" not in result, result


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0

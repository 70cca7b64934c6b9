"""Every registered query against its DuckDB oracle SQL (the driver's check), at sf0.001.

Set PANELFORGE_ORACLE_SF to another folder (e.g. /root/testdata/sf0.01) to run bigger.
"""

from __future__ import annotations

import os

import duckdb
import pytest

from tools.compare import TABLES, canon

from .conftest import SF001

SF = os.environ.get("PANELFORGE_ORACLE_SF", SF001)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _names():
    from __spark_entry__ import oracle_sql
    return sorted(oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    sdf = queries()[name](spark, SF).toPandas()
    odf = con.execute(oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert canon(sdf) == canon(odf)


def test_every_query_has_an_oracle():
    from __spark_entry__ import LLM_QUERIES, oracle_sql, queries
    # The columns of the whole wide panel depend on the data; panel_dense_long holds its cells to SQL.
    assert set(queries()) - set(LLM_QUERIES) - {"panel_wide"} == set(oracle_sql()) - set(LLM_QUERIES)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0 and "MSE" in df.columns

"""Every registered query against its DuckDB oracle on the smoke data."""

import importlib.util
import os

import duckdb
import pytest

from conftest import ROOT, SF_SMOKE
from hirescope.plans import queries as entry

_spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(ROOT, "scripts", "check_oracle.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        p = f"{SF_SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMOKE).toPandas()
    odf = con.execute(entry.oracle_sql()[name]).fetchdf()
    scols, srows = check.rows_of(sdf)
    ocols, orows = check.rows_of(odf)
    assert scols == ocols
    assert len(srows) == len(orows)
    assert srows == orows


def test_every_query_has_an_oracle():
    assert set(entry.queries()) == set(entry.oracle_sql())

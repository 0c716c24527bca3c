"""Every registered query against its SQL twin: names, types, row counts, values."""

from __future__ import annotations

import duckdb
import pytest
from compare import differences
from conftest import DATA

from oracles import ORACLES
from quarrylens.registry import registered
from quarrylens.sources.derived import BASE_TABLES

KEYS = sorted(registered())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(KEYS) == set(ORACLES)


@pytest.mark.parametrize("key", KEYS)
def test_matches_sql(spark, duck, key):
    got = registered()[key](spark, DATA).toArrow()
    want = duck.sql(ORACLES[key]).to_arrow_table()
    assert differences(got, want) == []

"""Every query with an SQL form against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracles import TABLES, canonical
from sensorloom.plans import catalog

_ORACLES = catalog.oracles()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(_ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    df = contract.queries()[name](spark, sf)
    mine = canonical([tuple(r) for r in df.collect()], df.columns)
    result = duck.execute(_ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert mine == canonical(result.fetchall(), names)
    assert mine


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_operator_is_shown():
    expected = {"A": 13, "B": 13, "C": 6, "D": 15, "E": 6, "F": 3, "G": 3, "H": 28, "I": 12, "J": 3, "K": 3}
    missing = {f"{g}{i}" for g, n in expected.items() for i in range(1, n + 1)} - set(catalog.coverage())
    assert not missing


def test_contract_holds_the_catalogue():
    assert set(catalog.queries()) <= set(contract.queries()) and set(_ORACLES) <= set(contract.oracle_sql())

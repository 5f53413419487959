"""Every bound query against its SQL on DuckDB, and the driver's contract."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__
from quantloom.bindings.catalog import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    bound = REGISTRY[name]
    df = bound.run(spark, SF_DIR)
    if bound.sql is None:
        assert df.columns and df.count() > 0
        return
    problem = compare(df, con, bound.sql)
    assert problem in (None, "no rows"), problem


def test_contract(spark):
    queries, oracle = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracle) <= set(queries) and len(oracle) > 120
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "excess_return_ln_12m" in df.columns


def test_inventory_is_covered():
    """Each operator id of the inventory has a bound query."""
    sizes = {"A": 17, "B": 21, "C": 10, "D": 12, "E": 11, "F": 6, "G": 3, "H": 19, "I": 10, "J": 2, "K": 20}
    wanted = {f"{group}{i}" for group, n in sizes.items() for i in range(1, n + 1)}
    assert not wanted - {c for b in REGISTRY.values() for c in b.covers}

"""Every registered query with SQL gives the SQL's rows on a small scale factor."""

import decimal
import importlib.util
import os

import pytest

from tallyfold.plans import registry

SF = "/root/testdata/sf0.001"


def one(v):
    if v is None or v != v:
        return "None"
    if isinstance(v, (int, float, decimal.Decimal)) and not isinstance(v, bool):
        return repr(round(float(v), 6) + 0.0)
    return str(v)


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(zip(*([one(v) for v in table.column(n).to_pylist()] for n in names)))


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    assert rows(registry.QUERIES[name](spark, SF).toArrow()) == rows(duck.sql(registry.ORACLES[name]).to_arrow_table())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_runs(spark, duck, name):
    assert registry.QUERIES[name](spark, SF).count() >= 0


def test_entry_imports_and_registers(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(registry.QUERIES) <= set(names) and set(entry.oracle_sql()) <= set(names)
    assert (importlib.util.find_spec("tallyfold.llm") is not None) == any(n.startswith("op") and n[2].isdigit() for n in names)
    assert entry.entry(spark).columns[0] == "o_custkey"

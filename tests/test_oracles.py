"""Every registered query against the SQL that must give the same rows."""

import pytest

import __spark_entry__ as entry_points
from martloom.plans import catalog
from tests.conftest import DATA

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES

SPARK_TO_SQL = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_points_hold_the_catalog():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    expected = duck.sql(ORACLES[name])
    assert sorted(expected.columns) == columns

    types = dict(zip(expected.columns, (str(t) for t in expected.types)))
    for field in df.schema:
        kind = field.dataType.simpleString()
        assert SPARK_TO_SQL.get(kind, kind.upper()) == types[field.name], field.name

    order = [expected.columns.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in order)) for r in expected.fetchall())
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert len(got) == len(want)
    assert got == want


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "new_customers_count"
    assert df.count() > 0

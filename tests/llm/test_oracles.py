"""Every training-data query that SQL can express against its SQL, on whole tables."""

import pytest

from martloom.llm.queries import ORACLES, QUERIES
from tests.conftest import DATA

SPARK_TO_SQL = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    expected = duck.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in df.schema} == types
    order = [expected.columns.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in order)) for r in expected.fetchall())
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert len(got) == len(want)
    assert got == want

import pytest

from slotstream.plans import queries
from tests.compare import SF, connect, same


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, con, name):
    same(queries.QUERIES[name](spark, SF), con, queries.ORACLE_SQL[name])


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.ORACLE_SQL)


def test_normalize_keys(spark):
    from slotstream.functions.project import normalize_keys

    rows = [(1, b"\x00\x00\x01", b"hello"), (2, None, b"")]
    got = normalize_keys(spark.createDataFrame(rows, "id int, a binary, b binary"), ["a", "b"]).orderBy("id").collect()
    assert [(r.a, r.b) for r in got] == [("112", "Cn8eVZg"), (None, "")]

"""Every query against its oracle, at a scale where each shape of line meets each agent."""

from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallyline.plans.catalog import QUERIES
from tallyline.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    connection.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_DIR}/events.parquet')")
    yield connection
    connection.close()


def _bag(rows) -> Counter:
    return Counter(tuple(row) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = duck.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    expected = result.fetchall()
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect()]
    assert len(got) == len(expected)
    assert expected, "an oracle without rows checks nothing"
    different = _bag(got) - _bag(expected)
    assert not different, (list(different)[:3], list(_bag(expected) - _bag(got))[:3])


def test_entry(spark):
    assert entry(spark).columns == ["event_date", "installer", "downloads"]

"""Every registered query against its SQL check; queries without one must give rows."""

import pytest

import __spark_entry__ as entry_points
from oracle import connect, differences

QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    frame = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        assert differences(frame, con, ORACLE[name]) == []
    else:
        assert frame.count() > 0


def test_entry_gives_the_report(spark):
    rows = entry_points.entry(spark).collect()
    assert [r.test_name for r in rows] == [
        "Overall Card Distribution", "Suit Distribution", "Rank Distribution", "Seed Uniqueness", "Card Coverage"]

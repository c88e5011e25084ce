"""Every registered query gives, value for value, what its SQL gives on the same tables."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import difference, oracle_rows
from checks.oracles import oracle_sql as table_oracles
from checks.queries import queries as table_queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    got = (df.columns, [tuple(r) for r in df.collect()])
    assert got[1]
    assert difference(got, oracle_rows(SF, ORACLES[name])) == ""


def test_every_query_has_an_oracle():
    assert set(table_queries()) == set(table_oracles())


def test_difference_sees_a_wrong_value():
    same = (["a", "b"], [(1, 2.0), (2, None)])
    assert difference(same, (["b", "a"], [(None, 2), (2.0, 1)])) == ""
    assert difference(same, (["a", "b"], [(1, 2.0000000001), (2, None)]))
    assert difference(same, (["a", "b"], [(1, 2.0)]))
    assert difference(same, (["a", "c"], same[1]))


def test_entry_is_the_flagship(spark):
    assert entry_points.entry(spark).columns[0] == "report_date"

import pytest
from oracle import assert_same

from strandline.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert_same(registry.queries()[name](spark, DATA), registry.oracle_sql()[name], DATA)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_position_joins_plan_no_nested_loop(spark):
    plan = registry.queries()["overlap_join"](spark, DATA)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan

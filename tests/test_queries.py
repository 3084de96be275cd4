"""Registered queries against their SQL on the smallest tables, and the plan of the full job."""

import os

import pytest

import __spark_entry__ as entry
from compare import check, duck

SF = "/root/testdata/sf0.001"
QUICK = sorted(n for n in entry.queries() if n[0] in "disk" or n.startswith(("t", "n1_", "n3", "n7_preprocess_c", "e4", "e8", "e14")))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", QUICK)
def test_matches_sql(spark, con, name):
    assert check(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF) is None


def test_every_query_is_named_in_both(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_enrichment_does_not_shuffle_events(spark):
    """With a small registry only dimensions are exchanged; events stay in one stage."""
    plan = entry.queries()["e11_enrich"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    events = plan[plan.rindex("events.parquet") - 4000 :] if "events.parquet" in plan else plan
    assert plan.count("BroadcastHashJoin") >= 5 and "CartesianProduct" not in events

"""Every registered query of the library against its SQL in DuckDB (the add-on has its own tests)."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from rollcall.plans.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


def test_every_query_has_sql_and_entry_runs(spark):
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_people_are_classified_once_per_row(spark):
    """However often a tier is used, its tests stand in the plan once."""
    plan = QUERIES["person_rows"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("stagiaire") == 1 and len(plan) < 100_000

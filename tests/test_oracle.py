"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from plexlake.catalog import all_oracles, all_queries
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_only_projection_tables_go_without_sql():
    assert set(all_queries()) - set(all_oracles()) == {"pca_scores", "pca_components"}
    assert set(all_queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, name):
    good, note = compare(spark, con, name, SF_DIR)
    assert good, note


def test_plans_hold_no_nested_loops(spark):
    for name in ("global_median_by_counts", "median_normalised", "sequence_search_shuffled", "accession_lookup_contains",
                 "high_median_flags", "combat_corrected", "log_odds", "densified_grid"):
        plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name

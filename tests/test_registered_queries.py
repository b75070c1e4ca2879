"""Every registered query beside its SQL on the same tables."""

import pytest
from conftest import SF001, SF01

from riskframe.workload import load_all
from tools.check import compare, connect

REGISTRY = load_all()
# Their planted effects need more rows than the smallest tables hold.
NEEDS_ROWS = ("tree", "prj24", "bin3", "e2_crash_study", "e2_saturated_study")


@pytest.fixture(scope="module")
def connections():
    return {d: connect(d) for d in (SF001, SF01)}


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, connections, name):
    sf_dir = SF01 if name.startswith(NEEDS_ROWS) else SF001
    assert compare(spark, connections[sf_dir], REGISTRY[name], sf_dir) is None


def test_entry_points_agree():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.queries())


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5

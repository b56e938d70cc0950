"""Physical-plan checks: JVM-only registry, pushdown, pruning, no single-partition ordering."""

import pytest

from tests.conftest import SF_SMALL, has_testdata

pytestmark = pytest.mark.skipif(not has_testdata(), reason="driver data missing")

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _names():
    from alertlake.plans.registry import QUERIES
    return list(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_no_python_in_registered_queries(spark, name):
    from alertlake.plans.registry import QUERIES
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert not any(n in p for n in PYTHON_NODES), name


def test_day_filter_pushed_to_scan(spark):
    from alertlake.plans.registry import QUERIES
    p = QUERIES["q_delta_partition"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in p and "LessThan(ts," in p


def test_columns_pruned(spark):
    from alertlake.plans.registry import QUERIES
    p = plan(QUERIES["q_sender_domain"](spark, SF_SMALL))
    assert "html" not in p.split("ReadSchema")[1].split("\n")[0] if "ReadSchema" in p else True
    p2 = plan(QUERIES["q_low_watermark"](spark, SF_SMALL))
    assert "props" not in p2


def test_ordered_ids_never_single_partition(spark):
    from alertlake.plans.registry import QUERIES
    for q in ("q_assign_ids", "q_pending", "q_worklist", "q_offer_rows"):
        assert "SinglePartition" not in plan(QUERIES[q](spark, SF_SMALL)), q

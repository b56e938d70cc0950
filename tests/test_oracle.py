"""Every registered query against its SQL oracle on the smallest driver data."""

import pytest

from tests.conftest import SF_SMALL, has_testdata

pytestmark = pytest.mark.skipif(not has_testdata(), reason="driver data missing")


def _names():
    from alertlake.plans.registry import QUERIES
    return list(QUERIES)


@pytest.fixture(scope="module")
def con():
    from tools.oracle_check import duck
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from alertlake.plans.registry import ORACLE, QUERIES
    from tools.oracle_check import compare
    line = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF_SMALL)
    assert line.startswith("OK") or "(no oracle)" in line, line

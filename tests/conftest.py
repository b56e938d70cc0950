import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from alertlake.session import get_spark

    s = get_spark("local[4]", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="alertlake-test-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return Path(tempfile.mkdtemp(prefix="alertlake-test-"))


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]


def has_testdata():
    return os.path.exists(SF_SMALL)

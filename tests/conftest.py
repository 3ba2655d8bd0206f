from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tributary.session import build_session
    s = build_session("local[4]", app="tributary-tests", shuffle_partitions=8)
    # The session's shared checkpoint folder is used when set; tests set their
    # own only where it is unset.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tributary-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from oracle_compare import duck
    return duck(SMALL)


def rows(df, *cols):
    """Collect (small test frames only) as sorted tuples."""
    cols = cols or tuple(df.columns)

    def key(t):
        return tuple((True, 0) if v is None else (False, v) for v in t)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)

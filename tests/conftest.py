import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark import checkpoint_dir, get_spark

    s = get_spark("local[*]", shuffle_partitions=8)
    # Tests only: a local checkpoint folder when the session names none.
    checkpoint_dir(s, default=tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tests.oracle_harness import duck

    return duck(SF_SMALL)

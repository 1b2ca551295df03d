import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from aulaframe.session import get_spark

    # tests only: a local shared folder when none is configured
    extra = {}
    ckpt = tempfile.mkdtemp(prefix="aulaframe-test-ckpt-")
    extra["spark.checkpoint.dir"] = ckpt
    s = get_spark("local[*]", app="aulaframe-tests", shuffle_partitions=8, extra=extra)
    yield s


@pytest.fixture(scope="session")
def registry():
    from aulaframe.plans.registry import load_all

    return load_all()


@pytest.fixture(scope="session")
def duck_small():
    from check_oracle import duck

    return duck(SF_SMALL)

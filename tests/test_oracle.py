"""Every analysis with a SQL oracle must equal it (rows, columns, types,
values) on the small data set; analyses without one must run."""

import os

import pytest

from aulaframe.plans.registry import load_all
from conftest import SF_MID, SF_SMALL

NAMES = sorted(load_all())
SF = SF_MID if os.environ.get("AULAFRAME_TEST_SF") == "0.01" else SF_SMALL


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, registry, name):
    from check_oracle import compare, duck

    con = duck(SF)
    r = compare(spark, con, registry[name], SF)
    assert "error" not in r, r
    assert "type_diff" not in r, r

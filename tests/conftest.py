from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sharelens.session import checkpoint_dir, get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("sharelens-tests", cpus=4, shuffle_partitions=4)
    checkpoint_dir(s)
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as tuples, sorted for order-free comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t)) if order is None else out

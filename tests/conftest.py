import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfwise.session import build_session, ensure_checkpoint_dir

    s = build_session("local[4]", app="shelfwise-tests", shuffle_partitions=8)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="shelfwise-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from shelfwise.session import scratch_path

    return scratch_path(spark, "tests")


def rows(df, *cols):
    """Sorted list of tuples (optionally of selected columns) for order-free asserts."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))

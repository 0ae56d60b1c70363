import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from platehub.session import build_session

    s = build_session(
        master="local[4]",
        app_name="platehub-tests",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="platehub-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def views(spark):
    from platehub.sources.views import Views

    return Views(spark, SF_SMALL)


def rows(df, cols=None):
    """Sorted list of tuples (order-insensitive comparisons)."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)

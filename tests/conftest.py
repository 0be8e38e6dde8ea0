import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="ledgerlens-tests", shuffle_partitions=4)
    # tests only: the cluster would name spark.checkpoint.dir itself
    checkpoint_dir(s, tempfile.mkdtemp(prefix="ledgerlens-ckpt-"))
    yield s


def rows(df, order=None):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r)) if order is None else out

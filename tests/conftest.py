import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zonekit.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[8]", app_name="zonekit-tests", shuffle_partitions=8,
                      extra_conf={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="zonekit-test-")


def _k(t):
    return tuple((v is not None, v if v is not None else 0) for v in t)


def rows(df, *cols):
    """Rows as sorted tuples (nulls first), for order-insensitive checks."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_k)

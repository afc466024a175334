import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("STRATALAKE_TEST_SF", "/root/testdata/sf0.001")
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stratalake.session import build_session
    s = build_session("local[*]", app_name="stratalake-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="stratalake-test-")


def rows(df, *cols):
    """Collected rows as sorted tuples (small test outputs only)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())

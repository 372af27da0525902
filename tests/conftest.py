import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("millrace-tests", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
                            spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_tables():
    """Smallest set of the given tables."""
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows():
    """Sorted plain rows of a frame."""
    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(type(v)), v) if v is not None
                                                                      else (True, "", "") for v in r])
    return collect

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from amity.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""

    def collect(df):
        return sorted(map(tuple, df.collect()), key=lambda r: [(x is None, x) for x in r])

    return collect

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from comarca.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="4", shuffle_partitions=4, memory="4g")


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    def collect(df, *columns):
        columns = columns or df.columns
        return sorted((tuple(r) for r in df.select(*columns).collect()),
                      key=lambda r: tuple((v is None, str(v)) for v in r))
    return collect

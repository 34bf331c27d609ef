import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from statmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "8", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture
def rows():
    """Rows of a frame as plain tuples in a fixed order."""
    def collect(df, *cols):
        df = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in df.collect()), key=lambda t: [(x is None, str(x)) for x in t])
    return collect

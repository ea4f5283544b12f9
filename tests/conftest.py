import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from newsloom.session import local_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests", partitions=4)


@pytest.fixture(scope="session")
def tables():
    if not Path(TABLES).exists():
        pytest.skip("no test tables here")
    return TABLES

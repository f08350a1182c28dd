import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent)]


@pytest.fixture(scope="session")
def spark():
    from skein.session import local_session

    return local_session()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"

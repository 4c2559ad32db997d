import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cadastra.session import local_session
    s = local_session("*", 8, app="cadastra-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    from tools.oracle_check import duck as make
    return make(SF_SMALL)


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)

import os

import pytest

from tessera.session import local_session

TESTDATA = os.environ.get("TESSERA_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, 4, "4g")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    return TESTDATA

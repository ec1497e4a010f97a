import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from fcbias.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", cores=8, **{"spark.checkpoint.dir": str(shared)})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def inputs(spark, folder):
    from fcbias.sources.standins import StandIns

    return StandIns(spark, folder)

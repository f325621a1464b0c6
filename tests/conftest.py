import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from carbonloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    return session


@pytest.fixture
def rows(spark):
    """rows(ddl, (…), (…)) -> DataFrame"""

    def make(ddl, *values):
        return spark.createDataFrame(list(values), ddl)

    return make

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from netwatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.ui.showConsoleProgress": "false"}
    session = build_session("local[4]", app_name="netwatch-tests", shuffle_partitions=8, conf=conf)
    # Tests only: a private shared folder when the session names none.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="netwatch-test-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def workdir(spark):
    from netwatch.session import fresh_dir
    return fresh_dir(spark, "tests")

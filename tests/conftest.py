import os

import pytest

from jobsignal.session import CHECKPOINT_DIR, build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "jobsignal-tests",
        os.environ.get("TEST_MASTER", "local[8]"),
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            CHECKPOINT_DIR: str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

import os

import pytest

from windflow.session import SETTINGS

SF = os.environ.get("WINDFLOW_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from windflow.session import build_session, shared_folder

    session = build_session("windflow-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.sql.session.timeZone": SETTINGS["spark.sql.session.timeZone"]})
    session.sparkContext.setLogLevel("ERROR")
    shared_folder(session, fallback=lambda: str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF

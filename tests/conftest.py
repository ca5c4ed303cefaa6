import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parents[1]))

from tidecart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tidecart-tests", **{
        "spark.master": "local[8]",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

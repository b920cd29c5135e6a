import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from textweir.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    session = build_session("textweir-tests", "4", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    folder = tempfile.mkdtemp(prefix="tidemark-test-")
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": f"{folder}/scratch", "spark.sql.warehouse.dir": f"{folder}/warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

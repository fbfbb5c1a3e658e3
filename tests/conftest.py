import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("PYTHONPATH", ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tillroll.session import build_session

    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = build_session("tests", "local[8]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

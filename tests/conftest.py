import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lectern.session import session

    shared = tmp_path_factory.mktemp("shared")
    s = session(
        "local[4]", **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{shared}",
            "spark.sql.warehouse.dir": str(shared / "warehouse"), "spark.ui.showConsoleProgress": "false",
        }
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from grainmart.config import SESSION_DEFAULTS  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.master("local[8]").appName("tests")
    for key, value in {
        **SESSION_DEFAULTS, "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog")),
    }.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

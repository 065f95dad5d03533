from pathlib import Path

import pytest
from pyspark.sql import SparkSession

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    out = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    out.sparkContext.setLogLevel("ERROR")
    yield out
    out.stop()

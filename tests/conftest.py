import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir("file://" + str(tmp_path_factory.mktemp("checkpoint")))
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Collected rows as a sorted list of tuples."""

    def get(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))

    return get

import sys
from pathlib import Path

import pytest
from pyspark import SparkConf
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from martflow.plans.scratch import CHECKPOINT_SETTING  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder
    if not SparkConf().get(CHECKPOINT_SETTING):
        builder = builder.config(CHECKPOINT_SETTING, str(tmp_path_factory.mktemp("scratch")))
    session = (
        builder.master("local[4]")
        .appName("martflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

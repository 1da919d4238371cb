import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("salescope-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.checkpoint.dir", str(folder))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

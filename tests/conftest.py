import pytest
from pyspark.sql import SparkSession

from tallyforge.workspace import clean_up, scratch_database


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tallyforge-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clean_up(session)
    left = [row[0] for row in session.sql("SHOW DATABASES").collect()]
    session.stop()
    assert left == ["default"]


@pytest.fixture
def database(spark):
    return scratch_database(spark)


@pytest.fixture
def ansi_off(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)

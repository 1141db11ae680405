import tempfile
import uuid

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("landfall-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{home}/warehouse")
        .config("spark.checkpoint.dir", f"{home}/checkpoint")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def db(spark):
    """Names of a fresh landing and curated database."""
    tag = uuid.uuid4().hex[:8]
    names = f"landing_{tag}", f"curated_{tag}"
    for name in names:
        spark.sql(f"CREATE DATABASE {name}")
    yield names
    for name in names:
        spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def zone(tmp_path):
    """Writes files into a landing folder."""
    folder = tmp_path / "landing"
    folder.mkdir()

    def write(name, text):
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    write.path = str(folder)
    return write

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# workers import the callables that test modules define
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")])

from verbamark.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        configure(SparkSession.builder.master("local[4]").appName("tests"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sorted_rows():
    def collect(df, *columns):
        rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))
    return collect

import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from usagelens.schemas import RAW_COLUMNS, RAW_EVENTS  # noqa: E402
from usagelens.session import configure  # noqa: E402
from usagelens.sources.employees import conform_employees  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "1000")  # plans name long folders whole
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def make_raw(spark):
    """Raw events from dicts; columns left out are null."""
    base = {"event_type": "telemetry.x", "event_name": "api_request",
            "timestamp": "2025-01-06T10:00:00.000Z", "session_id": "s1", "user_id": "u1",
            "email": "a@x", "model": "m", "terminal_type": "vscode",
            "organization_id": "o", "practice": "P"}

    def build(*rows):
        filled = [{**base, **row} for row in rows]
        return spark.createDataFrame(
            [tuple(r.get(c) for c in RAW_COLUMNS) for r in filled], RAW_EVENTS)

    return build


@pytest.fixture
def make_staff(spark):
    def build(*rows):
        return conform_employees(spark.createDataFrame(
            rows, "email string, full_name string, practice string, level string, "
                  "location string"))

    return build


@pytest.fixture
def evaluate(spark):
    """The values an expression over a string column ``x`` gives."""
    def run(expression, *values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType([
            T.StructField("i", T.IntegerType()), T.StructField("x", T.StringType())]))
        rows = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
        return [r["y"] for r in rows]

    return run

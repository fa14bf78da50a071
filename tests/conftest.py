import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallyloom.settings import apply_session_conf  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_session_conf(session)
    session.stop()


@pytest.fixture
def new_path():
    return tempfile.mkdtemp(prefix="run-") + "/table"


def plan_of(frame) -> str:
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def values(frame, *columns):
    return [tuple(row[name] for name in columns) if len(columns) > 1 else row[columns[0]]
            for row in frame.collect()]

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from snapledger.session import build_session, shared_dir  # noqa: E402
from snapledger.sources.store import VersionStore  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        "snapledger-tests",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return VersionStore(spark, str(tmp_path / uuid.uuid4().hex))


@pytest.fixture
def employees(spark):
    def build(*rows):
        df = spark.createDataFrame(
            [tuple(r) for r in rows], "employee_id string, salary int, manager string, department string"
        )
        return df.withColumn("salary", df.salary.cast("decimal(18,2)"))

    return build

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sensorloom.session import local_session, release

    session = local_session(
        8,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release()
    session.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SMALL


def plan_of(df) -> str:
    """Physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()

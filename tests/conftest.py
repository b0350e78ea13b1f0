import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vialflow.session import get_session
    s = get_session("local[4]", app="vialflow-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "8g",
                           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="vialflow-test-ckpt-"),
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="vialflow-test-wh-")})
    yield s


@pytest.fixture(scope="session")
def queries():
    from vialflow.plans.registry import all_queries
    return all_queries()

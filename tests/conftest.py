import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tarmac.session import get_spark
    s = get_spark("local[4]", "tarmac-tests", {"spark.sql.shuffle.partitions": "8",
                                               "spark.driver.memory": "4g"})
    yield s
    s.stop()

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hirescope.session import local_session

    s = local_session("*", app="hirescope-tests", **{"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


def one_col(spark, values, name="v", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")

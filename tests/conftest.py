import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hydrolake.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app_name="hydrolake-tests",
                      extra={"spark.driver.memory": "4g"})
    yield s


def one(spark, expr_df):
    return [tuple(r) for r in expr_df.collect()]

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from splitsafe.session import local_session
    s = local_session("*", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def loan(spark):
    from tests.fixtures import loan_apps
    return loan_apps(spark, 4000, seed=7)

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from clickwell.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app_name="clickwell-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def raw_ads_tiny(spark):
    from clickwell.schemas import ADS_RAW_TEXT
    from tiny_inputs import tiny_ads_rows
    return spark.createDataFrame(tiny_ads_rows(), ADS_RAW_TEXT)


@pytest.fixture
def raw_exp_tiny(spark):
    from clickwell.schemas import EXPERIMENT_RAW_TEXT
    from tiny_inputs import tiny_experiment_rows
    return spark.createDataFrame(tiny_experiment_rows(), EXPERIMENT_RAW_TEXT)

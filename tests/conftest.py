import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from trip_engine.session import build_session
    spark = build_session("local[*]", app_name="trip-engine-tests", shuffle_partitions=8,
                          extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wh-")})
    yield spark
    spark.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)

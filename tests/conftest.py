import os
import sys
import time
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Spark and Python agree on the zone, so collected timestamps are UTC wall-clock
    os.environ["TZ"] = "UTC"
    time.tzset()
    from vigil.session import build_session

    session = build_session("local[4]", app_name="vigil-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def workdir(spark):
    """A fresh folder below the shared folder (spark.checkpoint.dir)."""
    from vigil.session import fresh_dir

    return fresh_dir(spark, "test")

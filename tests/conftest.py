import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = build_session("local[4]", app="strata-tests", shuffle_partitions=8,
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="strata-test-ckpt-"),
                                 "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="strata-test-wh-")})
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="strata-test-")

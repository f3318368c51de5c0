import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martline.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", app="martline-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="martline-ckpt-"),
                         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="martline-warehouse-")})
    yield s


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)

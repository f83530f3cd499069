import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from econ_lake.session import get_spark

    s = get_spark("local[4]", shuffle_partitions=4,
                  extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="econ-lake-test-")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="econ-lake-case-")

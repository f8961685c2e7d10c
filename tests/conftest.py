import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terrafold.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build("local[4]", **{"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


SF = "/root/testdata/sf0.001"

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session("8", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    return session


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"

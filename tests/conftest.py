import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from restock.session import local_session

    session = local_session("8", "tests", 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from restock.bridge import Tables

    return Tables(spark, FOLDER)


@pytest.fixture(scope="session")
def oracle():
    import compare

    return compare.connect(FOLDER)

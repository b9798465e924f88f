import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session
from millrace.sources import SCHEMAS

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "millrace-tests")
    yield session
    session.stop()


@pytest.fixture(params=["sf0.001", "sf0.01", "sf0.1"])
def sf_dir(request):
    path = f"{DATA}/{request.param}"
    if not os.path.isdir(path):
        pytest.fail(f"{path} is not there")
    return path


@pytest.fixture
def duck(sf_dir):
    with duckdb.connect() as con:
        for name in SCHEMAS:
            con.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
            )
        yield con

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from agroclim.session import local_session

    session = local_session("*", shuffle_partitions=8, app="agroclim-tests")
    yield session
    session.stop()


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]

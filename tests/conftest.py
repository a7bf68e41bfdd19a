import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kinnear.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=4, driver_memory="4g")
    yield s


# G1: hand-checkable 5 users x 6 items (fixed values of the fixture)
G1_TRAIN = [
    (1, 1, 5.0), (1, 2, 3.0), (1, 3, 4.0),
    (2, 1, 4.0), (2, 2, 1.0), (2, 4, 5.0),
    (3, 1, 1.0), (3, 2, 5.0), (3, 4, 2.0),
    (4, 3, 2.0), (4, 4, 2.0),
    (5, 5, 3.0), (5, 1, 5.0),
]
G1_TEST = [(1, 4, 4.0), (2, 3, 3.0), (3, 3, 2.0), (4, 1, 3.0), (5, 2, 4.0), (1, 6, 3.0)]
RATINGS = "user long, item long, rating double"


@pytest.fixture(scope="session")
def g1(spark):
    return (
        spark.createDataFrame(G1_TRAIN, RATINGS),
        spark.createDataFrame(G1_TEST, RATINGS),
    )

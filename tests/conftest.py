import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ticketlake.session import get_spark
    ck = tempfile.mkdtemp(prefix="ticketlake-test-")
    s = get_spark("local[4]", app="ticketlake-tests", shuffle_partitions=4,
                  **{"spark.checkpoint.dir": ck, "spark.default.parallelism": "4"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricing_rows import TXN_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from shelfmark.session import get_session
    s = get_session("local[4]", app="shelfmark-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfmark-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture
def make_txn(spark):
    def build(rows):
        return spark.createDataFrame(rows, TXN_SCHEMA)
    return build

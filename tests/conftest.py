import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from talkmill.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=8, app_name="talkmill-tests",
                    extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    yield s
    s.stop()


@pytest.fixture()
def texts(spark):
    """Build a one-column DataFrame of texts with a key."""
    def make(values, col="text"):
        return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id BIGINT, {col} STRING")
    return make

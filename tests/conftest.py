import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickscope.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="clickscope-test-")
    session = build_session(
        master="local[4]",
        shuffle_partitions=8,
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()

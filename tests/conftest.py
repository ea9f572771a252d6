import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from metaweave.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="mw-tests-")
    session = get_session(
        "local[8]",
        app_name="metaweave-tests",
        shuffle_partitions=8,
        conf={
            "spark.driver.memory": "8g",
            # Unset on a local run, so the tests name their own shared folder.
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    yield session
    session.stop()

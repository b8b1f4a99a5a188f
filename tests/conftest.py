import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerflow.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tests own their session, so they set the shared folder themselves.
    work = tempfile.mkdtemp(prefix="ledgerflow-tests-")
    s = build_session("local[*]", "ledgerflow-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": os.path.join(work, "checkpoints"),
                             "spark.driver.memory": "4g"})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="ledgerflow-run-")

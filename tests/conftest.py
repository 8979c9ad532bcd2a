import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from histmill.session import build_session

    with tempfile.TemporaryDirectory(prefix="histmill-tests-") as folder:
        s = build_session("local[4]", shuffle_partitions=4, app_name="histmill-tests", checkpoint_dir=folder)
        yield s
        s.stop()
